"""SentencePiece models run by the tokenizers library (operator 10).

The model's protobuf is read into the parts of a tokenizers pipeline: normaliser (character map, extra
spaces, leading space, space as the marker U+2581), a split into runs of markers with what follows them, the
unigram scores or the merges that the BPE scores stand for, byte fallback, and a decoder that undoes them.

Parity with the sentencepiece library is verified for every text: by its pieces where the vocabulary lets
no token reach over a marker (each distinct piece once per batch), else by the whole text.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

from siltstone.llm.common import by_bytes, per_worker, prepared

MARK = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# Fixed values of the model format: kinds of models and of pieces.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
_PIECE = f"{MARK}+[^{MARK}]*|[^{MARK}]+"
COUNTS = ("ids", "n_tokens", "round_trip", "parity")


def read_model(data: bytes):
    from sentencepiece import sentencepiece_model_pb2
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(data)
    return proto


def splittable(proto) -> bool:
    """No token holds a marker behind another character, and a text is only changed by markers: then pieces are encoded independently."""
    norm = proto.normalizer_spec
    return (not any(MARK in p.piece.lstrip(MARK) for p in proto.pieces) and not norm.precompiled_charsmap
            and not norm.remove_extra_whitespaces and norm.add_dummy_prefix and norm.escape_whitespaces
            and not any(p.type == USER_DEFINED for p in proto.pieces))


def build(data: bytes) -> Tokenizer:
    """The tokenizer of a serialized model. Models of whole words or characters and unused pieces are refused."""
    proto = read_model(data)
    if proto.trainer_spec.model_type not in (UNIGRAM, BPE) or proto.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("only unigram and BPE models with the marker in front are supported")
    if any(p.type == UNUSED for p in proto.pieces):
        raise ValueError("unused pieces aren't supported")
    unknown = next(i for i, p in enumerate(proto.pieces) if p.type == UNKNOWN)
    fallback = proto.trainer_spec.byte_fallback
    if proto.trainer_spec.model_type == UNIGRAM:
        # Control and unknown pieces get names that no text holds; what isn't normal must not lower the unknown score.
        low = min(p.score for p in proto.pieces if p.type == NORMAL)
        vocab = [(f"\U0010FFFF{p.piece}" if p.type in (CONTROL, UNKNOWN) else p.piece, p.score if p.type in (NORMAL, USER_DEFINED) else low) for p in proto.pieces]
        model = models.Unigram(vocab, unk_id=unknown, byte_fallback=fallback)
    else:
        ids = {p.piece: i for i, p in enumerate(proto.pieces)}
        score = {p.piece: p.score for p in proto.pieces if p.type in (NORMAL, USER_DEFINED)}
        merges = [(-s, ids[whole[:cut]], ids[whole[cut:]], whole[:cut], whole[cut:])
                  for whole, s in score.items() for cut in range(1, len(whole)) if whole[:cut] in score and whole[cut:] in score]
        model = models.BPE(ids, [m[3:] for m in sorted(merges)], unk_token=proto.pieces[unknown].piece, fuse_unk=True, byte_fallback=fallback)
    out = Tokenizer(model)
    norm, steps = proto.normalizer_spec, []
    if norm.precompiled_charsmap:
        steps.append(normalizers.Precompiled(norm.precompiled_charsmap))
    if norm.remove_extra_whitespaces:
        steps += [normalizers.Replace(Regex(r"\A +| +\z"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if norm.add_dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    if norm.escape_whitespaces:
        steps.append(normalizers.Replace(" ", MARK))
    out.normalizer = normalizers.Sequence(steps)
    cuts = []
    if not any(MARK in p.piece.lstrip(MARK) for p in proto.pieces):
        cuts.append(pre_tokenizers.Split(Regex(_PIECE), "isolated"))
    if fallback and proto.trainer_spec.model_type == UNIGRAM:  # the name of a byte piece, written in a text, is ordinary text
        cuts.append(pre_tokenizers.Split(Regex("<(?=0x[0-9A-F]{2}>)"), "isolated"))
    if cuts:
        out.pre_tokenizer = pre_tokenizers.Sequence(cuts)
    out.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
                                    + ([decoders.Strip(" ", 1, 0)] if norm.add_dummy_prefix else []))
    out.add_tokens([AddedToken(p.piece, normalized=True) for p in proto.pieces if p.type == USER_DEFINED])
    out.encode_special_tokens = True
    return out


class Encoder:
    """Encodes texts by the tokenizers library, decodes them again, and compares with sentencepiece.

    Where pieces are encoded independently, each distinct one is encoded, decoded and compared once and remembered;
    a text is what its pieces are. If more than MEMORY are known, those of the last texts alone stay known. The library
    gets AT_ONCE pieces at a time.
    """

    MEMORY = 600_000
    AT_ONCE = 10_000

    def __init__(self, data: bytes, tokenizer: str) -> None:
        self.tokenizer, self.model = Tokenizer.from_str(tokenizer), sentencepiece.SentencePieceProcessor(model_proto=data)
        self.tokenizer.encode_special_tokens = True
        self.by_piece = splittable(read_model(data))
        if self.by_piece:  # pieces are normalised already
            self.tokenizer.normalizer = normalizers.Sequence([])
        self.find, self.known = re.compile(_PIECE).findall, {}
        self.other, self.lossy = set(), set()  # pieces that sentencepiece encodes otherwise; that decode to something else

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[bool], list[bool]]:
        """For each text the ids as 32-bit numbers, whether decoding gives it back, and parity."""
        if not self.by_piece:
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            back = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
            return ([np.array(i, "<i4").tobytes() for i in ids], [a == b for a, b in zip(back, texts, strict=True)],
                    [a == b for a, b in zip(ids, self.model.encode(texts, num_threads=1), strict=True)])
        pieces = [self.find((MARK + t).replace(" ", MARK)) if t else [] for t in texts]
        found = {p for ps in pieces for p in ps}
        self._learn([p for p in found if p not in self.known])
        ids = [b"".join(map(self.known.__getitem__, ps)) for ps in pieces]
        back = [MARK not in t and (not self.lossy or self.lossy.isdisjoint(ps)) for t, ps in zip(texts, pieces, strict=True)]
        same = [not self.other or self.other.isdisjoint(ps) for ps in pieces]
        if len(self.known) > self.MEMORY:
            self.known = {p: self.known[p] for p in found}
            self.other, self.lossy = self.other & found, self.lossy & found
        return ids, back, same

    def _learn(self, new: list[str]) -> None:
        for start in range(0, len(new), self.AT_ONCE):
            part = new[start:start + self.AT_ONCE]
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            texts = [p[1:].replace(MARK, " ") for p in part]  # the decoder takes the first space away, sentencepiece puts it there
            self.lossy.update(p for p, a, b in zip(part, self.tokenizer.decode_batch(ids, skip_special_tokens=False), texts, strict=True) if a != b)
            for p, a, b in zip(part, ids, self.model.encode(texts, num_threads=1), strict=True):
                if a != (b if p != MARK else [self.model.piece_to_id(MARK)]):  # alone: a text's last space
                    self.other.add(p)
                self.known[p] = np.array(a, "<i4").tobytes()


def tokenize(docs: DataFrame, model: str = MODEL, threads: int = 2) -> DataFrame:
    """The columns of `docs` with ids array<int>, n_tokens, round_trip and parity.

    round_trip: decoding gives the text back. parity: the ids are those of the sentencepiece library. A null
    text has no ids and is read as empty. Texts are encoded whole, whatever their length. Repeated rows are alike; an
    empty table gives no rows; columns of the same names are replaced, all others kept. `model` is a file
    that the driver reads; executors get its bytes, and a worker keeps the encoder for its later tasks. `threads`: of the library in each task.
    """
    spark = prepared(docs.sparkSession)
    with open(model, "rb") as file:
        data = file.read()
    shared, mark = spark.sparkContext.broadcast((data, build(data).to_str())), hashlib.sha256(data).hexdigest()  # as large as the model's file
    names = [c for c in docs.columns if c not in COUNTS]
    given = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(names)], F.coalesce("text", F.lit("")).alias("_text"))
    schema = ", ".join([f"_k{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(names)]
                       + ["ids array<int>", "n_tokens long", "round_trip boolean", "parity boolean"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["RAYON_NUM_THREADS"], os.environ["TOKENIZERS_PARALLELISM"] = str(threads), "true"
        encoder = per_worker("sentencepiece_backend", mark, lambda: Encoder(*shared.value))
        for batch in by_bytes(batches, "_text", 2 << 20):
            ids, back, same = encoder.encode(batch.column("_text").to_pylist())
            lengths = np.array([len(i) // 4 for i in ids], np.int64)
            places = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(places), pa.array(np.frombuffer(b"".join(ids), "<i4")))
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + [lists, pa.array(lengths), pa.array(back, pa.bool_()), pa.array(same, pa.bool_())],
                                             names=[f"_k{i}" for i in range(len(names))] + list(COUNTS))

    return given.mapInArrow(run, schema).withColumnsRenamed({f"_k{i}": c for i, c in enumerate(names)})
