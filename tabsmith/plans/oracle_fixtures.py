"""DuckDB text of the fixtures in ``tabsmith.sources.fixtures`` (oracle side)."""

from __future__ import annotations

from tabsmith.functions.keyed import u_sql
from tabsmith.sources.fixtures import N_DIMS, N_FORMS, PRED_MODELS

DIRTY_EVENTS = f"""dirty_events AS (
  SELECT event_id AS row_id,
    CASE WHEN lb = 0 THEN upper(event_type) || ' '
         WHEN lb = 1 THEN lower(event_type)
         WHEN lb = 2 THEN translate(upper(event_type), 'EO', '30')
         WHEN lb = 3 THEN ' ' || upper(event_type) || chr(9)
         WHEN lb = 4 THEN 'N/A'
         WHEN lb = 5 THEN NULL
         WHEN lb = 6 THEN upper(substr(event_type, 1, 1)) || substr(event_type, 2, 100)
         ELSE upper(event_type) END AS label_raw,
    CASE WHEN nb = 0 THEN txt || ' cm'
         WHEN nb = 1 THEN txt || 'cm'
         WHEN nb = 2 THEN '?'
         WHEN nb = 3 THEN ''
         WHEN nb = 4 THEN NULL
         ELSE txt END AS num_raw,
    user_id
  FROM (SELECT event_id, user_id, event_type,
               floor({u_sql('event_id', "'lab'")} * 23) AS lb,
               floor({u_sql('event_id', "'num'")} * 29) AS nb,
               CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS txt
        FROM events) e
)"""

ORDER_FEATURES = f"""li_agg AS (
  SELECT l_orderkey, count(*) AS n,
         sum(CAST(l_quantity AS DECIMAL(18,2))) AS sq,
         sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS sp,
         sum(CAST(l_discount AS DECIMAL(18,2))) AS sd,
         sum(CAST(l_tax AS DECIMAL(18,2))) AS st
  FROM lineitem GROUP BY l_orderkey
),
order_features AS (
  SELECT o_orderkey AS row_id, o_orderpriority AS class,
         CAST(o_totalprice AS DOUBLE) AS total_price,
         CAST(n AS DOUBLE) AS n_lines,
         CAST(sq AS DOUBLE) AS sum_qty,
         CASE WHEN {u_sql('o_orderkey', "'h2'")} >= 0.005 THEN CAST(sq AS DOUBLE) / CAST(n AS DOUBLE) END AS avg_qty,
         CASE WHEN {u_sql('o_orderkey', "'h1'")} >= 0.005 THEN CAST(sp AS DOUBLE) END AS sum_price,
         CAST(sp AS DOUBLE) / CAST(n AS DOUBLE) AS avg_price,
         CAST(sd AS DOUBLE) / CAST(n AS DOUBLE) AS avg_discount,
         CAST(st AS DOUBLE) / CAST(n AS DOUBLE) AS avg_tax
  FROM orders LEFT JOIN li_agg ON o_orderkey = l_orderkey
)"""

LINE_STATS = """line_stats AS (
  SELECT l_returnflag || l_linestatus AS class,
         CAST(l_quantity AS DOUBLE) AS l_quantity, CAST(l_extendedprice AS DOUBLE) AS l_extendedprice,
         CAST(l_discount AS DOUBLE) AS l_discount, CAST(l_tax AS DOUBLE) AS l_tax
  FROM lineitem
)"""

VECTORS = ("vectors AS (\n  SELECT vec_id AS row_id, CAST(label AS INTEGER) AS label, "
           + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS x{i}" for i in range(N_DIMS))
           + "\n  FROM embeddings\n)")

_forms = ", ".join(f"CAST(embedding[{c + 1}] AS DOUBLE) + CAST(embedding[{c + 11}] AS DOUBLE) + CAST(embedding[{c + 21}] AS DOUBLE)"
                   for c in range(N_FORMS))
LEARNABLE_VECTORS = f"""learnable AS (
  SELECT vec_id AS row_id, CAST(list_position([{_forms}], list_max([{_forms}])) - 1 AS INTEGER) AS label FROM embeddings)"""

_models = " UNION ALL ".join(f"SELECT '{m}' AS model, {r} AS err_rate" for m, r in PRED_MODELS)
_us = [f"({u_sql('row_id', repr(f'p{j}') + ' || model')} + CASE WHEN predicted = {j} THEN 2.0 ELSE 0.0 END)"
       for j in range(5)]
PREDICTIONS = f"""pred_models AS ({_models}),
pred_base AS (
  SELECT o_orderkey AS row_id, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1 AS actual, model, err_rate,
         CASE WHEN {u_sql('o_orderkey', "'split'")} < 0.7 THEN 'train' ELSE 'test' END AS split
  FROM orders CROSS JOIN pred_models
),
pred_labels AS (
  SELECT model, split, row_id, actual,
         CAST(CASE WHEN {u_sql('row_id', "'err' || model")} <
                        CASE WHEN split = 'train' THEN err_rate / 2 ELSE err_rate END
              THEN (actual + 1 + CAST(floor({u_sql('row_id', "'alt' || model")} * 4) AS INTEGER)) % 5
              ELSE actual END AS INTEGER) AS predicted
  FROM pred_base
),
pred_u AS (
  SELECT model, split, row_id, actual, predicted, [{', '.join(_us)}] AS u FROM pred_labels
),
predictions AS (
  SELECT model, split, row_id, actual, predicted,
         list_transform(u, lambda x: x / (u[1] + u[2] + u[3] + u[4] + u[5])) AS proba
  FROM pred_u
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
