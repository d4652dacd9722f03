"""SELECTs of all kinds, each run as a query dataset: stored by partition, read back.

The query text is the user's; these show that joins, grouping sets, windows, set
operations and the rest pass through. Where the checking engine spells something
differently, its text stands next to ours.

A table that may repeat a key very often is cut to one row per key before it is
joined where only the key matters, so that no task gets all rows of a hot key.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class SqlDataset:
    query: str
    partition_col: str
    tables: tuple[str, ...]
    check: str | None = None

    @property
    def check_sql(self) -> str:
        return self.check or self.query


SQL_DATASETS: dict[str, SqlDataset] = {
    "sql_pricing_summary": SqlDataset(
        """
        SELECT l_returnflag, l_linestatus,
               cast(sum(cast(l_quantity AS decimal(12, 2))) AS double) AS sum_qty,
               cast(sum(cast(l_extendedprice AS decimal(12, 2))
                        * (1 - cast(l_discount AS decimal(4, 2)))) AS double) AS revenue,
               max(l_tax) AS max_tax, count(*) AS n_lines
        FROM lineitem WHERE l_shipdate <= date '1998-09-02'
        GROUP BY l_returnflag, l_linestatus""",
        "l_returnflag",
        ("lineitem",),
    ),
    "sql_join_agg_window": SqlDataset(
        """
        SELECT n_name, n_orders, cast(rank() OVER (ORDER BY n_orders DESC) AS int) AS place
        FROM (SELECT n_name, count(*) AS n_orders
              FROM orders JOIN customer ON o_custkey = c_custkey
                          JOIN nation ON c_nationkey = n_nationkey
              GROUP BY n_name)""",
        "place",
        ("orders", "customer", "nation"),
    ),
    "sql_region_volume": SqlDataset(
        """
        SELECT r_name, n_name, cast(year(o_orderdate) AS int) AS year,
               cast(sum(cast(l_extendedprice AS decimal(12, 2))) AS double) AS volume
        FROM region JOIN nation ON n_regionkey = r_regionkey
             JOIN supplier ON s_nationkey = n_nationkey
             JOIN lineitem ON l_suppkey = s_suppkey
             JOIN orders ON l_orderkey = o_orderkey
        GROUP BY r_name, n_name, year(o_orderdate)""",
        "year",
        ("region", "nation", "supplier", "lineitem", "orders"),
    ),
    "sql_left_join": SqlDataset(
        """
        SELECT c_custkey, c_mktsegment, coalesce(n_orders, 0) AS n_orders,
               coalesce(greatest, 0) AS greatest
        FROM customer LEFT JOIN (
            SELECT o_custkey, count(*) AS n_orders, max(o_totalprice) AS greatest
            FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey) ON o_custkey = c_custkey""",
        "c_mktsegment",
        ("customer", "orders"),
    ),
    "sql_full_join": SqlDataset(
        """
        SELECT coalesce(c.nation, s.nation) AS nation, coalesce(n_customers, 0) AS n_customers,
               coalesce(n_suppliers, 0) AS n_suppliers
        FROM (SELECT c_nationkey AS nation, count(*) AS n_customers FROM customer
              WHERE c_acctbal < 0 GROUP BY c_nationkey) c
        FULL JOIN (SELECT s_nationkey AS nation, count(*) AS n_suppliers FROM supplier
                   WHERE s_acctbal < 0 GROUP BY s_nationkey) s ON c.nation = s.nation""",
        "n_suppliers",
        ("customer", "supplier"),
    ),
    "sql_exists": SqlDataset(
        """
        SELECT c_custkey, c_name, c_nationkey FROM customer c
        WHERE EXISTS (SELECT 1 FROM (SELECT DISTINCT o_custkey FROM orders
                                     WHERE o_orderstatus = 'F') o
                      WHERE o.o_custkey = c.c_custkey)
          AND c_acctbal > (SELECT avg(c_acctbal) FROM customer)""",
        "c_nationkey",
        ("customer", "orders"),
    ),
    "sql_not_exists": SqlDataset(
        """
        SELECT p_partkey, p_brand, p_retailprice FROM part
        WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT l_partkey FROM lineitem
                                         WHERE l_quantity > 45) l
                          WHERE l.l_partkey = p_partkey)""",
        "p_brand",
        ("part", "lineitem"),
    ),
    "sql_rollup": SqlDataset(
        """
        SELECT o_orderstatus, o_orderpriority, cast(grouping_id() AS int) AS level,
               count(*) AS n_orders, count(DISTINCT o_custkey) AS n_customers
        FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)""",
        "level",
        ("orders",),
        """
        SELECT o_orderstatus, o_orderpriority,
               cast(grouping(o_orderstatus, o_orderpriority) AS int) AS level,
               count(*) AS n_orders, count(DISTINCT o_custkey) AS n_customers
        FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)""",
    ),
    "sql_cube": SqlDataset(
        """
        SELECT coalesce(l_returnflag, 'all') AS flag, coalesce(l_linestatus, 'all') AS status,
               count(*) AS n_lines, min(l_shipdate) AS first_day
        FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""",
        "flag",
        ("lineitem",),
    ),
    "sql_grouping_sets": SqlDataset(
        """
        SELECT coalesce(p_brand, '-') AS brand, coalesce(p_type, '-') AS kind,
               count(*) AS n_parts, max(p_retailprice) AS dearest
        FROM part GROUP BY GROUPING SETS ((p_brand), (p_type), ())""",
        "kind",
        ("part",),
    ),
    "sql_having": SqlDataset(
        """
        SELECT o_custkey, count(*) AS n_orders, cast(count(DISTINCT year(o_orderdate)) AS int) AS n_years
        FROM orders GROUP BY o_custkey
        HAVING count(*) >= 10 AND max(o_totalprice) > 100000""",
        "n_years",
        ("orders",),
    ),
    "sql_case_pivot": SqlDataset(
        """
        SELECT o_orderpriority,
               sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS closed,
               sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS open,
               sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS pending
        FROM orders GROUP BY o_orderpriority""",
        "o_orderpriority",
        ("orders",),
        """
        SELECT o_orderpriority,
               cast(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS bigint) AS closed,
               cast(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS bigint) AS open,
               cast(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS bigint) AS pending
        FROM orders GROUP BY o_orderpriority""",
    ),
    "sql_set_operations": SqlDataset(
        """
        (SELECT DISTINCT o_custkey AS custkey, 'both' AS part FROM orders WHERE o_orderstatus = 'F'
         INTERSECT SELECT DISTINCT o_custkey, 'both' FROM orders WHERE o_orderstatus = 'O')
        UNION ALL
        (SELECT c_custkey, 'none' FROM customer
         EXCEPT SELECT DISTINCT o_custkey, 'none' FROM orders)""",
        "part",
        ("orders", "customer"),
    ),
    "sql_top_per_group": SqlDataset(
        """
        SELECT * FROM (
            SELECT o_custkey, o_orderkey, o_orderpriority,
                   cast(row_number() OVER (PARTITION BY o_custkey
                        ORDER BY o_totalprice DESC, o_orderkey) AS int) AS place
            FROM orders) WHERE place <= 3""",
        "place",
        ("orders",),
    ),
    "sql_running_total": SqlDataset(
        """
        SELECT event_type, cast(ts AS date) AS day, count(*) AS n_events,
               cast(sum(sum(cast(round(value * 100) AS bigint))) OVER (PARTITION BY event_type
                    ORDER BY cast(ts AS date)) AS bigint) AS cents_so_far
        FROM events GROUP BY event_type, cast(ts AS date)""",
        "event_type",
        ("events",),
    ),
    "sql_month_on_month": SqlDataset(
        """
        WITH months AS (
            SELECT cast(year(o_orderdate) AS int) AS year, cast(month(o_orderdate) AS int) AS month,
                   count(*) AS n_orders
            FROM orders GROUP BY year(o_orderdate), month(o_orderdate))
        SELECT year, month, n_orders,
               n_orders - coalesce(lag(n_orders) OVER (ORDER BY year, month), 0) AS change
        FROM months""",
        "year",
        ("orders",),
    ),
    "sql_text_functions": SqlDataset(
        """
        SELECT doc_id, lang, upper(source) AS source, length(text) AS n_text,
               size(split(text, ' ')) AS n_parts, md5(text) AS digest
        FROM documents""",
        "lang",
        ("documents",),
        """
        SELECT doc_id, lang, upper(source) AS source, cast(length(text) AS int) AS n_text,
               cast(len(string_split(text, ' ')) AS int) AS n_parts, md5(text) AS digest
        FROM documents""",
    ),
    "sql_regexp": SqlDataset(
        """
        SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS host, count(*) AS n_pages,
               substr(url, 1, 5) = 'https' AS secure
        FROM pages GROUP BY regexp_extract(url, '^https?://([^/]+)', 1), substr(url, 1, 5)""",
        "secure",
        ("pages",),
    ),
    "sql_array_functions": SqlDataset(
        """
        SELECT vec_id, label, size(embedding) AS n_dims,
               cast(element_at(embedding, 1) AS double) AS first_dim,
               cast(array_max(embedding) AS double) AS greatest
        FROM embeddings""",
        "label",
        ("embeddings",),
        """
        SELECT vec_id, label, cast(len(embedding) AS int) AS n_dims,
               cast(embedding[1] AS double) AS first_dim,
               cast(list_max(embedding) AS double) AS greatest
        FROM embeddings""",
    ),
    "sql_unnest": SqlDataset(
        """
        SELECT lang, length(word) AS n_letters, count(*) AS n_words
        FROM documents LATERAL VIEW explode(split(text, ' ')) w AS word
        GROUP BY lang, length(word)""",
        "lang",
        ("documents",),
        """
        SELECT lang, cast(length(word) AS int) AS n_letters, count(*) AS n_words
        FROM (SELECT lang, unnest(string_split(text, ' ')) AS word FROM documents)
        GROUP BY lang, length(word)""",
    ),
    "sql_json_path": SqlDataset(
        """
        SELECT event_type, cast(get_json_object(props, '$.k') AS int) % 10 AS k, count(*) AS n_events
        FROM events GROUP BY event_type, cast(get_json_object(props, '$.k') AS int) % 10""",
        "event_type",
        ("events",),
        """
        SELECT event_type, cast(json_extract_string(props, '$.k') AS int) % 10 AS k,
               count(*) AS n_events
        FROM events GROUP BY event_type, cast(json_extract_string(props, '$.k') AS int) % 10""",
    ),
}
