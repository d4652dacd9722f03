"""For each query of ``queries``, the SQL that another engine can check it with."""

from __future__ import annotations

from querymill.plans.sql_datasets import SQL_DATASETS

_DATE_PARTS = """
    SELECT *, cast(year(o_orderdate) AS integer) AS year,
           cast(month(o_orderdate) AS integer) AS month
    FROM orders"""

_SPLIT = "substr(md5({key} || '|3'), 1, 8) < 'cccccccc'"

_POINTS = """
    points AS (
        SELECT vec_id, label,
               cast(embedding[1] AS double) AS x0, cast(embedding[2] AS double) AS x1,
               cast(embedding[3] AS double) AS x2, cast(embedding[4] AS double) AS x3,
               substr(md5(cast(vec_id AS varchar) || '|3'), 1, 8) < 'cccccccc' AS is_train
        FROM embeddings)"""

_NEAREST = f"""
    WITH {_POINTS},
    ranked AS (
        SELECT e.vec_id, e.label, t.vec_id AS nearest_id, t.label AS predicted,
               (e.x0 - t.x0) * (e.x0 - t.x0) + (e.x1 - t.x1) * (e.x1 - t.x1)
               + (e.x2 - t.x2) * (e.x2 - t.x2) + (e.x3 - t.x3) * (e.x3 - t.x3) AS square
        FROM points e JOIN points t ON NOT e.is_train AND t.is_train),
    nearest AS (
        SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY square, nearest_id) AS place
        FROM ranked)"""

_NEIGHBORS = (
    _NEAREST
    + " SELECT vec_id, nearest_id, predicted, sqrt(square) AS distance FROM nearest WHERE place = 1"
)

_NEAREST_WHOLE = f"""
    WITH points AS (
        SELECT vec_id, label, {", ".join(f"cast(embedding[{i + 1}] AS double) AS x{i}" for i in range(64))},
               {_SPLIT.format(key="cast(vec_id AS varchar)")} AS is_train
        FROM embeddings),
    ranked AS (
        SELECT e.vec_id, e.label, t.vec_id AS nearest_id, t.label AS predicted,
               {" + ".join(f"(e.x{i} - t.x{i}) * (e.x{i} - t.x{i})" for i in range(64))} AS square
        FROM points e JOIN points t ON NOT e.is_train AND t.is_train),
    nearest AS (
        SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY square, nearest_id) AS place
        FROM ranked)"""

_LATEST = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
              ORDER BY o_orderdate DESC, o_orderkey DESC) AS place FROM orders)
    WHERE place = 1"""

_MODELS = """
    models AS (
        SELECT c_mktsegment AS model_group,
               strftime(o_orderdate, '%Y-%m-%d') || '-' || o_orderkey AS version,
               'model-package/' || c_mktsegment || '/' || strftime(o_orderdate, '%Y-%m-%d')
                   || '-' || o_orderkey AS model_package_arn,
               CASE WHEN o_orderstatus = 'F' THEN 'Approved'
                    ELSE 'PendingManualApproval' END AS approval_status,
               o_orderdate
        FROM orders JOIN customer ON o_custkey = c_custkey)"""

ORACLE: dict[str, str] = {
    "query_to_partitions": _DATE_PARTS,
    "query_to_partitions_limit": _DATE_PARTS + " ORDER BY o_orderkey LIMIT 5000",
    "partition_edge_values": """
        SELECT doc_id, n_chars, CASE WHEN doc_id % 5 = 0 THEN ''
                                     WHEN doc_id % 5 <> 1 THEN lang END AS lang
        FROM documents""",
    "select_all": "SELECT * FROM lineitem",
    "date_parts": _DATE_PARTS,
    "date_parts_limit": _DATE_PARTS + " ORDER BY o_orderkey LIMIT 5000",
    "string_date_year": """
        WITH dated AS (
            SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d')
                   || CASE WHEN o_orderstatus = 'P' THEN '?' ELSE '' END AS day
            FROM orders)
        SELECT o_orderkey, day,
               cast(coalesce(year(try_cast(day AS timestamp)), 0) AS integer) AS year,
               cast(coalesce(month(try_cast(day AS timestamp)), 0) AS integer) AS month
        FROM dated""",
    "zone_dates": """
        SELECT event_id, cast(ts + INTERVAL 8 HOUR AS date) AS today,
               cast(ts + INTERVAL 8 HOUR - INTERVAL 1 DAY AS date) AS yesterday,
               strftime(ts + INTERVAL 8 HOUR - INTERVAL 1 DAY, '%Y-%m-%d') AS folder
        FROM events""",
    "path_parts": """
        WITH named AS (
            SELECT doc_id, source, lang,
                   's3://docs/' || source || '/' || lang || '/' || doc_id || '/part.txt' AS uri
            FROM documents)
        SELECT doc_id, 's3a' || substr(uri, 3) AS uri_s3a, 'docs' AS bucket,
               source || '/' || lang || '/' || doc_id || '/part.txt' AS prefix,
               substr(uri, 1, length(uri) - length('/part.txt')) AS dirname,
               'part.txt' AS basename, doc_id || '-part.txt' AS tail_name
        FROM named""",
    "load_timestamp": "SELECT count(*) AS n_rows, cast(1 AS bigint) AS n_times FROM customer",
    "first_columns": "SELECT p_partkey, p_name, p_brand, p_type FROM part",
    "drop_label": "SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part",
    "prediction_only": "SELECT doc_id, quality AS predicted_score FROM labels",
    "head_by_key": "SELECT * FROM customer ORDER BY c_custkey LIMIT 5",
    "latest_per_key": _LATEST,
    "incremental_latest": _LATEST,
    "distributed_together": f"""
        SELECT year, month, count(*) AS n_rows, cast(1 AS bigint) AS n_tasks
        FROM ({_DATE_PARTS}) GROUP BY year, month""",
    "distributed_split": "SELECT * FROM lineitem",
    "partitioned_roundtrip": _DATE_PARTS,
    "pruned_partition": f"SELECT * FROM ({_DATE_PARTS}) WHERE year = 1996 AND month <= 6",
    "replaced_partition": """
        SELECT o_orderkey, o_custkey,
               CASE WHEN year(o_orderdate) = 1996 THEN 'X' ELSE o_orderstatus END
                   AS o_orderstatus,
               o_totalprice, o_orderdate, o_orderpriority,
               cast(year(o_orderdate) AS integer) AS year
        FROM orders""",
    "bounded_files": "SELECT count(*) AS n_rows, true AS within_bound FROM lineitem",
    "query_roundtrip": _DATE_PARTS,
    "ctas_roundtrip": _DATE_PARTS,
    "csv_roundtrip": "SELECT * FROM customer",
    "csv_text_roundtrip": "SELECT * FROM documents",
    "hashed_neighbor_recall": f"""
        SELECT count(*) AS n_rows, true AS recall_reached FROM embeddings
        WHERE NOT {_SPLIT.format(key="cast(vec_id AS varchar)")}""",
    "csv_parallel_text": "SELECT * FROM documents",
    "ordered_half": """
        SELECT * FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber
        LIMIT (SELECT count(*) // 2 FROM lineitem)""",
    "ordered_half_ties": """
        SELECT l_shipdate, l_returnflag FROM lineitem ORDER BY l_shipdate, l_returnflag
        LIMIT (SELECT count(*) // 3 FROM lineitem)""",
    "asof_previous_event": """
        WITH one AS (
            SELECT user_id, ts, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type
            FROM events GROUP BY user_id, ts)
        SELECT e.event_id, e.user_id, e.ts, e.event_type,
               coalesce(p.event_id, -1) AS last_event_id,
               p.ts AS last_ts, p.event_type AS last_event_type
        FROM events e ASOF LEFT JOIN one p ON e.user_id = p.user_id AND e.ts > p.ts""",
    "asof_order_of_event": """
        WITH one AS (
            SELECT o_orderdate + INTERVAL 8760 DAYS AS made_at, max(o_orderkey) AS o_orderkey
            FROM orders GROUP BY ALL)
        SELECT event_id, ts, o_orderkey, made_at
        FROM events ASOF LEFT JOIN one ON ts >= made_at""",
    "overlapping_orders": """
        WITH open AS (
            SELECT o_orderkey, o_custkey, o_orderdate AS s,
                   o_orderdate + to_days(cast(floor(o_totalprice / 1000) AS integer)) AS e
            FROM orders WHERE o_totalprice >= 1000)
        SELECT p.o_custkey, p.o_orderkey AS a, q.o_orderkey AS b
        FROM open p JOIN open q ON p.o_custkey = q.o_custkey AND p.o_orderkey < q.o_orderkey
            AND p.s < q.e AND q.s < p.e""",
    "range_join": """
        SELECT c_custkey, s_suppkey, c_acctbal AS c_from FROM customer JOIN supplier
        ON c_acctbal BETWEEN s_acctbal - abs(s_acctbal) / 1000 AND s_acctbal + abs(s_acctbal) / 1000""",
    "csv_one_column": """
        SELECT CASE WHEN doc_id % 7 = 0 THEN '' WHEN doc_id % 7 <> 1 THEN text END AS text
        FROM documents""",
    "json_roundtrip": "SELECT * FROM customer",
    "json_text_roundtrip": "SELECT * FROM conversations",
    "latest_version": """
        SELECT *, '2026-01-02T00.00.00.000Z' AS version FROM customer WHERE c_acctbal >= 0""",
    "all_versions": """
        SELECT *, '2026-01-01T00.00.00.000Z' AS version FROM customer
        UNION ALL
        SELECT *, '2026-01-02T00.00.00.000Z' AS version FROM customer WHERE c_acctbal >= 0""",
    "all_versions_evolved": """
        SELECT *, '2026-01-01T00.00.00.000Z' AS version FROM customer
        UNION ALL BY NAME
        SELECT c_custkey, c_name, c_nationkey, c_mktsegment,
               '2026-01-02T00.00.00.000Z' AS version FROM customer""",
    "versions_from_paths": """
        SELECT *, 'v1' AS version FROM customer
        UNION ALL SELECT *, 'v2' AS version FROM customer WHERE c_acctbal >= 0""",
    "external_table": "SELECT * FROM part",
    "declared_csv": "SELECT * FROM part",
    "declared_parquet": "SELECT * FROM part",
    "prefix_scan": "SELECT * FROM orders",
    "hash_split": f"SELECT doc_id, {_SPLIT.format(key='doc_id')} AS is_train FROM documents",
    "nearest_neighbor": _NEIGHBORS,
    "nearest_neighbor_leaves": _NEIGHBORS,
    "nearest_neighbor_whole": _NEAREST_WHOLE
    + " SELECT vec_id, nearest_id, predicted, sqrt(square) AS distance FROM nearest WHERE place = 1",
    "accuracy_whole": _NEAREST_WHOLE
    + """ SELECT avg(CASE WHEN label = predicted THEN 1.0 ELSE 0.0 END) AS accuracy
          FROM nearest WHERE place = 1""",
    "accuracy": _NEAREST
    + """ SELECT avg(CASE WHEN label = predicted THEN 1.0 ELSE 0.0 END) AS accuracy
          FROM nearest WHERE place = 1""",
    "fitted_class_totals": """
        SELECT label, cast(count(*) AS double) AS n_rows FROM embeddings GROUP BY label""",
    "fitted_feature_sums": f"""
        WITH {_POINTS}
        SELECT label, round(sum(x0), 2) AS sum_x0, round(sum(x1), 2) AS sum_x1,
               round(sum(x2), 2) AS sum_x2, round(sum(x3), 2) AS sum_x3
        FROM points GROUP BY label""",
    "stream_scores": "SELECT o_orderkey, o_orderpriority AS predicted_score FROM orders",
    "interleaved_layout": """
        SELECT * FROM lineitem WHERE l_shipdate >= timestamp '1997-01-01' AND l_partkey % 7 < 5""",
    "train_and_score": "SELECT o_orderkey, o_orderpriority AS predicted_score FROM orders",
    "batch_score": "SELECT o_orderkey, o_orderpriority AS predicted_score FROM orders",
    "insert_if_absent": """
        SELECT * FROM customer WHERE NOT EXISTS (
            SELECT 1 FROM orders WHERE o_custkey = c_custkey
            AND o_orderdate >= timestamp '2001-01-01 00:00:00')""",
    "register_groups": """
        SELECT DISTINCT c_mktsegment AS model_group, '' AS description FROM customer""",
    "groups_deduplicated": """
        SELECT DISTINCT CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END
                            AS model_group, '' AS description
        FROM customer""",
    "register_packages": f"""
        WITH {_MODELS}
        SELECT model_group, version, model_package_arn,
               's3://models/store/' || version || '-model.tar.gz' AS model_url,
               'test' AS description, 'PendingManualApproval' AS approval_status
        FROM models""",
    "approve_event": f"""
        WITH {_MODELS} SELECT model_package_arn, approval_status FROM models""",
    "registry_compacted": f"""
        WITH {_MODELS} SELECT model_package_arn, approval_status FROM models""",
    "registry_pending": f"""
        WITH {_MODELS} SELECT model_package_arn, approval_status FROM models
        WHERE approval_status = 'PendingManualApproval'""",
    "registry_status": f"""
        WITH {_MODELS} SELECT model_package_arn, approval_status FROM models
        WHERE model_group = 'BUILDING'""",
    "approved_latest": f"""
        WITH {_MODELS},
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY model_group ORDER BY version DESC) AS place
            FROM models WHERE approval_status = 'Approved')
        SELECT model_group, version, model_package_arn,
               o_orderdate + INTERVAL 1 DAY AS updated_at
        FROM ranked WHERE place = 1""",
    "version_link": f"""
        WITH {_MODELS}
        SELECT version, model_group, model_package_arn FROM models WHERE version < '1996'""",
    "deployment_names": f"""
        WITH {_MODELS}
        SELECT 'flower-model-' || model_group || '-' || version AS model_name, model_package_arn
        FROM models WHERE approval_status = 'Approved'""",
    "train_and_deploy": """
        SELECT o_orderkey, o_orderpriority AS predicted_score,
               'flower-model-test-2026-01-01' AS model_name
        FROM orders""",
    "stamp_and_preview": "SELECT * FROM customer ORDER BY c_custkey LIMIT 5",
} | {name: dataset.check_sql for name, dataset in SQL_DATASETS.items()}
