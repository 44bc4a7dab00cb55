"""The source views of FIXTURES.md as SQL, name → query."""

FIXTURE: dict[str, str] = {
    "film0": """
        SELECT CAST(FLOOR(p_partkey/10) AS BIGINT) AS film_id, MIN(p_name) AS title, MIN(p_type) AS description,
        CAST(1990+MAX(p_size)%30 AS INT) AS release_year, CAST(MAX(p_size)*3 AS INT) AS length, MAX(p_size) AS
        rental_duration, CAST(MAX(p_retailprice) AS DECIMAL(12,2)) AS rental_rate, CAST(MAX(p_retailprice)*2 AS
        DECIMAL(12,2)) AS replacement_cost, MIN(p_brand) AS rating FROM part GROUP BY FLOOR(p_partkey/10)""",
    "inventory0": """
        SELECT p_partkey AS inventory_id, CAST(FLOOR(p_partkey/10) AS BIGINT) AS film_id, CAST(p_partkey%25
        AS BIGINT) AS store_id FROM part""",
    "city0": """
        SELECT CAST(r_regionkey AS BIGINT) AS city_id, r_name AS city FROM region""",
    "address0": """
        SELECT CAST(n_nationkey AS BIGINT) AS address_id, n_name AS address, n_name AS district,
        CAST(n_regionkey AS BIGINT) AS city_id FROM nation""",
    "store0": """
        SELECT CAST(n_nationkey AS BIGINT) AS store_id, CAST(n_nationkey%10 AS BIGINT) AS manager_staff_id,
        CAST(n_nationkey AS BIGINT) AS address_id FROM nation""",
    "staff0": """
        SELECT s_suppkey AS staff_id, s_name AS first_name, s_name AS last_name, CAST(s_nationkey AS BIGINT)
        AS address_id, CAST(s_nationkey AS BIGINT) AS store_id FROM supplier""",
    "rental0": """
        SELECT o.o_orderkey AS rental_id, o.o_orderdate AS rental_date, l.inventory_id, o.o_custkey AS
        customer_id, l.return_date, l.staff_id FROM orders o JOIN (SELECT l_orderkey, MAX(l_partkey) AS
        inventory_id, MAX(l_suppkey) AS staff_id, MAX(l_shipdate) AS return_date FROM lineitem GROUP BY
        l_orderkey) l ON l.l_orderkey = o.o_orderkey""",
    "payment0": """
        SELECT o.o_orderkey AS payment_id, o.o_custkey AS customer_id, COALESCE(r.staff_id, 0) AS staff_id,
        o.o_orderkey AS rental_id, CAST(o.o_totalprice AS DECIMAL(12,2)) AS amount, o.o_orderdate AS
        payment_date FROM orders o LEFT JOIN rental0 r ON r.rental_id = o.o_orderkey""",
    "film1": """
        SELECT *, TIMESTAMP '2001-12-01 00:00:00' AS last_update FROM film0 WHERE film_id%20<>19""",
    "film2": """
        SELECT film_id, title, description, release_year, length, rental_duration, CAST(CASE WHEN
        film_id%20=3 THEN rental_rate+1 ELSE rental_rate END AS DECIMAL(12,2)) AS rental_rate,
        replacement_cost, CASE WHEN film_id%20=13 THEN CONCAT(rating,'*') ELSE rating END AS rating, CASE
        WHEN film_id%20 IN (3,13,19) THEN TIMESTAMP '2002-01-12 00:00:00' WHEN film_id%50=1 THEN TIMESTAMP
        '2002-01-01 00:00:00' ELSE TIMESTAMP '2001-12-01 00:00:00' END AS last_update FROM film0 WHERE
        film_id%40<>6""",
    "inventory1": """
        SELECT *, TIMESTAMP '2001-12-01 00:00:00' AS last_update, CAST(NULL AS TIMESTAMP) AS deleted FROM
        inventory0 WHERE inventory_id%20<>19""",
    "inventory2": """
        SELECT inventory_id, CASE WHEN inventory_id%20=3 AND film_id+1 <= (SELECT MAX(film_id) FROM film0)
        THEN film_id+1 ELSE film_id END AS film_id, CASE WHEN inventory_id%20=13 THEN (store_id+1)%25 ELSE
        store_id END AS store_id, CASE WHEN inventory_id%20 IN (3,13,19) THEN TIMESTAMP '2002-01-10
        00:00:00' WHEN inventory_id%50=1 THEN TIMESTAMP '2002-01-01 00:00:00' ELSE TIMESTAMP '2001-12-01
        00:00:00' END AS last_update, CASE WHEN inventory_id%25=4 THEN TIMESTAMP '2002-01-15 00:00:00' END
        AS deleted FROM inventory0 WHERE inventory_id%40<>6""",
    "staff1": """
        SELECT *, TIMESTAMP '2001-12-01 00:00:00' AS last_update, CAST(NULL AS TIMESTAMP) AS deleted FROM
        staff0 WHERE staff_id%20<>19""",
    "staff2": """
        SELECT staff_id, CASE WHEN staff_id%20=3 THEN CONCAT(first_name,' II') ELSE first_name END AS
        first_name, last_name, address_id, CASE WHEN staff_id%20=13 THEN (store_id+1)%25 ELSE store_id END
        AS store_id, CASE WHEN staff_id%20 IN (3,13,19) THEN TIMESTAMP '2002-01-10 00:00:00' WHEN
        staff_id%50=1 THEN TIMESTAMP '2002-01-01 00:00:00' ELSE TIMESTAMP '2001-12-01 00:00:00' END AS
        last_update, CASE WHEN staff_id%25=4 THEN TIMESTAMP '2002-01-15 00:00:00' END AS deleted FROM staff0
        WHERE staff_id%40<>6""",
    "rental1": """
        SELECT rental_id, rental_date, inventory_id, customer_id, CASE WHEN (rental_id+7)%20=3 THEN NULL
        ELSE return_date END AS return_date, staff_id, TIMESTAMP '2001-12-15 00:00:00' AS last_update,
        CAST(NULL AS TIMESTAMP) AS deleted FROM rental0 WHERE (rental_id+7)%20<>19""",
    "rental2": """
        SELECT rental_id, rental_date, CASE WHEN (rental_id+7)%20=13 THEN 1 ELSE inventory_id END AS
        inventory_id, customer_id, return_date, staff_id, CASE WHEN (rental_id+7)%20 IN (3,13,19) THEN
        TIMESTAMP '2002-01-20 00:00:00' WHEN (rental_id+7)%50=1 THEN TIMESTAMP '2002-01-01 00:00:00' ELSE
        TIMESTAMP '2001-12-15 00:00:00' END AS last_update, CASE WHEN (rental_id+7)%25=4 THEN TIMESTAMP
        '2002-01-15 00:00:00' END AS deleted FROM rental0 WHERE (rental_id+7)%40<>6""",
    "payment1": """
        SELECT *, TIMESTAMP '2001-12-15 00:00:00' AS last_update, CAST(NULL AS TIMESTAMP) AS deleted FROM
        payment0 WHERE payment_id%20<>19""",
    "payment2": """
        SELECT payment_id, customer_id, CASE WHEN payment_id%20=13 THEN 5 ELSE staff_id END AS staff_id,
        rental_id, CAST(CASE WHEN payment_id%20=3 THEN amount+1 ELSE amount END AS DECIMAL(12,2)) AS amount,
        payment_date, CASE WHEN payment_id%20 IN (3,13,19) THEN TIMESTAMP '2002-01-20 00:00:00' WHEN
        payment_id%50=1 THEN TIMESTAMP '2002-01-01 00:00:00' ELSE TIMESTAMP '2001-12-15 00:00:00' END AS
        last_update, CASE WHEN payment_id%25=4 THEN TIMESTAMP '2002-01-15 00:00:00' END AS deleted FROM
        payment0 WHERE payment_id%40<>6""",
    "address1": """
        SELECT *, TIMESTAMP '2001-12-01 00:00:00' AS last_update FROM address0 WHERE address_id%20<>19""",
    "address2": """
        SELECT address_id, CASE WHEN address_id%20=3 THEN CONCAT(address,' *') ELSE address END AS address,
        district, city_id, CASE WHEN address_id%20 IN (3,19) THEN TIMESTAMP '2002-01-10 00:00:00' ELSE
        TIMESTAMP '2001-12-01 00:00:00' END AS last_update FROM address0 WHERE address_id%40<>6""",
    "city1": """
        SELECT *, TIMESTAMP '2001-12-01 00:00:00' AS last_update FROM city0 WHERE city_id%20<>19""",
    "city2": """
        SELECT city_id, CASE WHEN city_id%20=3 THEN CONCAT(city,' *') ELSE city END AS city, CASE WHEN
        city_id%20 IN (3,19) THEN TIMESTAMP '2002-01-10 00:00:00' ELSE TIMESTAMP '2001-12-01 00:00:00' END
        AS last_update FROM city0 WHERE city_id%40<>6""",
    "store1": """
        SELECT *, TIMESTAMP '2001-12-01 00:00:00' AS last_update FROM store0 WHERE store_id%20<>19""",
    "store2": """
        SELECT store_id, CASE WHEN store_id%20=3 THEN 5 ELSE manager_staff_id END AS manager_staff_id,
        address_id, CASE WHEN store_id%20 IN (3,19) THEN TIMESTAMP '2002-01-10 00:00:00' ELSE TIMESTAMP
        '2001-12-01 00:00:00' END AS last_update FROM store0 WHERE store_id%40<>6""",
}
