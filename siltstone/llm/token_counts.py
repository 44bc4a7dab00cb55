"""Token counts by the libraries of public tokenizers (operator 11).

Texts go to the library in batches of about equal bytes, and only lengths come back. A long text is cut into
segments where that cannot change its tokens; the counts of its segments are summed, so no list of a whole
long text's tokens is ever held.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import by_bytes, per_worker, prepared, raw

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
LIMIT = 4096
SEGMENT = 4 << 10  # characters of a segment, at about
TOGETHER = 256 << 10  # characters given to the library at once, at about
COUNTS = ("n_bytes", "n_tokens", "over_limit")
_MARK = "\u2581"  # fixed value: what SentencePiece writes for a space
_NORMAL, _USER_DEFINED = 1, 4  # fixed values: kinds of pieces in the model format


class PieceLengths:
    """Lengths by a SentencePiece model, without begin and end."""

    def __init__(self, data: bytes) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(data)
        norm, kinds = proto.normalizer_spec, {p.piece: p.type for p in proto.pieces}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=data)
        # Where every text begins with a marker of its own, spaces become markers, nothing else is changed and no piece holds a
        # marker behind another character, what stands behind a space is encoded as if it were a text of its own.
        safe = (norm.add_dummy_prefix and norm.escape_whitespaces and not norm.remove_extra_whitespaces and not norm.precompiled_charsmap
                and not proto.trainer_spec.treat_whitespace_as_suffix and kinds.get(_MARK) == _NORMAL
                and not any(_MARK in piece.lstrip(_MARK) for piece in kinds) and _USER_DEFINED not in kinds.values())
        self.cut = re.compile(f"(?<=[^ {_MARK}]) (?=[^ {_MARK}])") if safe else None
        self.drops = 1  # the space itself: the next segment gets its marker from the library

    def __call__(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(texts, num_threads=1)]


class TokenizerLengths:
    """Lengths by a file of the tokenizers library, without added tokens, truncation or padding."""

    def __init__(self, data: bytes) -> None:
        from tokenizers import Tokenizer
        spec = json.loads(data)
        self.model = Tokenizer.from_str(data.decode())
        self.model.no_truncation()
        self.model.no_padding()
        # The byte-level pattern begins a new run at a single space between letters, and such a file changes no text before that.
        split = spec.get("pre_tokenizer") or {}
        safe = (split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space") and not spec.get("normalizer")
                and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec.get("added_tokens") or []))
        self.cut = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])") if safe else None
        self.drops = 0

    def __call__(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]


def segments(text: str, lengths: PieceLengths | TokenizerLengths, size: int = SEGMENT) -> Iterator[str]:
    """The text in parts of about `size` characters whose tokens are those of the text; whole where no safe place is known."""
    start = 0
    while lengths.cut and len(text) - start > size:
        place = lengths.cut.search(text, start + size)
        if place is None:
            break
        yield text[start:place.start()]
        start = place.start() + lengths.drops
    yield text[start:] if start else text


def count_all(texts: list[str], lengths: PieceLengths | TokenizerLengths, size: int = SEGMENT, together: int = TOGETHER) -> np.ndarray:
    """Tokens of each text. Segments of all texts are gathered until they hold about `together` characters."""
    counts, parts, owners, held = np.zeros(len(texts), np.int64), [], [], 0

    def flush() -> None:
        np.add.at(counts, owners, lengths(parts))

    for owner, text in enumerate(texts):
        for part in segments(text, lengths, size) if text else ():
            parts.append(part)
            owners.append(owner)
            held += len(part)
            if held >= together:
                flush()
                parts, owners, held = [], [], 0
    if parts:
        flush()
    return counts


def count_tokens(docs: DataFrame, tokenizer: str = MODEL, limit: int = LIMIT, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns `keep` of `docs` with n_bytes (UTF-8), n_tokens and over_limit (more than `limit` tokens).

    `tokenizer` is a file that the driver reads, of SentencePiece (.model) or of the tokenizers library (.json); executors
    get its bytes. A null text counts as empty: no bytes, no tokens. Texts are counted whole, whatever their length; a text
    without a safe place to cut is one segment. Bytes that are not UTF-8 count as bytes and are read as U+FFFD. Repeated rows
    are alike, each with its own count; a null id stays null; an empty table gives no rows. Columns that aren't in `keep`, of
    whatever name, are left out, and so is a kept one with the name of a result. One pass, without a shuffle.
    """
    spark = prepared(docs.sparkSession)
    with open(tokenizer, "rb") as file:
        data = file.read()
    kind = PieceLengths if tokenizer.endswith(".model") else TokenizerLengths
    shared, mark = spark.sparkContext.broadcast(data), hashlib.sha256(data).hexdigest()  # as large as the tokenizer's file
    names = [c for c in keep if c not in COUNTS]
    given = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(names)], F.col("text").cast("binary").alias("_text"))
    schema = ", ".join([f"_k{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(names)]
                       + ["n_bytes long", "n_tokens long", "over_limit boolean"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = per_worker("token_counts", mark, lambda: kind(shared.value))
        for batch in by_bytes(batches, "_text"):
            texts = [raw(t) for t in batch.column("_text").to_pylist()]
            sizes = np.array([len(t) for t in texts], np.int64)
            counts = count_all([t.decode("utf-8", "replace") for t in texts], lengths)
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + [pa.array(sizes), pa.array(counts), pa.array(counts > limit)],
                                             names=[f"_k{i}" for i in range(len(names))] + list(COUNTS))

    return given.mapInArrow(run, schema).withColumnsRenamed({f"_k{i}": c for i, c in enumerate(names)})
