"""Registered queries over the driver tables, each with an equivalent SQL
statement for an independent engine (the correctness oracle).

Every query reads whole tables (or JSON text Spark derives from them), so its
work grows with the data.  Randomizing operators have no exact oracle; their
queries return deterministic violation counts whose expected values are 0.

The SQL builders below produce the oracle statements; they are written in a
different form from the Spark expressions where one exists (for example the
position mask is a per-character list comprehension in SQL, while the Spark
side compiles the format to runs).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.operators import drift, keys, lake, validate
from veilspark.operators.protect import apply_policy, apply_policy_json, keep_all_json, protect_json
from veilspark.operators.rules_table import RULE, protect_asof_table, protect_json_by_table
from veilspark.operators.versions import apply_policy_asof, protect_json_asof
from veilspark.plans import inputs
from veilspark.plans import policies as P
from veilspark.policy import rules_frame
from veilspark.session import scratch_dir
from veilspark.streaming.enrich import EnrichStream, enrich_frame, fields_map
from veilspark.streaming.fields import FieldWatch
from veilspark.streaming.metrics import count_columns, sketch_columns, united

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


# The operator's own output where a query reads it back into columns to compare it.
OUTPUTS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def output_of(name: str):
    def deco(fn):
        OUTPUTS[name] = fn
        return fn
    return deco


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


# ---------------------------------------------------------------------------
# SQL snippets for the oracle
# ---------------------------------------------------------------------------
def q_mask_default(c: str) -> str:
    return (f"CASE WHEN length({c}) = 0 THEN {c} WHEN length({c}) <= 2 THEN repeat('*', length({c})) "
            f"ELSE left({c}, 1) || repeat('*', length({c}) - 2) || right({c}, 1) END")


def q_mask_format(c: str, fmt: str) -> str:
    return (f"CASE WHEN length({c}) = 0 THEN {c} ELSE array_to_string([CASE WHEN i <= {len(fmt)} AND "
            f"substr('{fmt}', i, 1) IN ('X', 'x') THEN substr({c}, i, 1) ELSE '*' END "
            f"FOR i IN range(1, length({c}) + 1)], '') END")


def q_hash(c: str) -> str:
    return f"CASE WHEN length({c}) = 0 THEN {c} ELSE base64(unhex(sha256({c}))) END"


def q_label(x: str, ranges: list[int]) -> str:
    b = sorted(ranges)
    arms = [f"WHEN {x} < {b[0]} THEN '<{b[0]}'"]
    arms += [f"WHEN {x} < {hi} THEN '{lo}-{hi}'" for lo, hi in zip(b, b[1:]) if lo < hi]
    return f"CASE {' '.join(arms)} ELSE '{b[-1]}+' END"


def q_int_of_double(x: str) -> str:
    return (f"(CASE WHEN isnan({x}) THEN 0 WHEN {x} >= 2147483647 THEN 2147483647 "
            f"WHEN {x} <= -2147483648 THEN -2147483648 ELSE CAST(trunc({x}) AS INTEGER) END)")


def q_int_of_text(t: str) -> str:
    return f"COALESCE(CASE WHEN regexp_full_match({t}, '[+-]?[0-9]+') THEN TRY_CAST({t} AS INTEGER) END, 0)"


def q_low32(x: str) -> str:
    return f"(CAST((({x}) % 4294967296 + 4294967296) % 4294967296 AS BIGINT) - CASE WHEN ((({x}) % 4294967296 + 4294967296) % 4294967296) >= 2147483648 THEN 4294967296 ELSE 0 END)"


# ---------------------------------------------------------------------------
# protection operators on typed columns
# ---------------------------------------------------------------------------
@register("mask_default", f"""
SELECT c_custkey, {q_mask_default('c_name')} AS c_name, {q_mask_default('c_mktsegment')} AS c_mktsegment
FROM customer""")
def mask_default(spark, d):
    return apply_policy(inputs.table(spark, d, "customer"), P.MASK_DEFAULT, id_col="c_custkey")


@register("mask_format", f"""
SELECT s_suppkey, {q_mask_format('s_name', P.SUPPLIER_FORMAT)} AS s_name FROM supplier""")
def mask_format(spark, d):
    return apply_policy(inputs.table(spark, d, "supplier"), P.MASK_FORMAT, id_col="s_suppkey")


@register("mask_nonstring_identity", """
SELECT c_custkey, c_acctbal, c_nationkey FROM customer""")
def mask_nonstring_identity(spark, d):
    return apply_policy(inputs.table(spark, d, "customer"), P.MASK_NONSTRING, id_col="c_custkey")


@register("hash_value", f"""
SELECT c_custkey, {q_hash('c_name')} AS c_name, {q_hash('CAST(c_custkey AS VARCHAR)')} AS c_custkey_text
FROM customer""")
def hash_value(spark, d):
    c = inputs.table(spark, d, "customer").select("c_custkey", "c_name",
                                                  F.col("c_custkey").alias("c_custkey_text"))
    return apply_policy(c, P.HASH, id_col="c_custkey")


@register("redact", """
SELECT c_custkey, '[REDACTED]' AS c_name, CAST(NULL AS DOUBLE) AS c_acctbal, CAST(NULL AS INTEGER) AS c_nationkey
FROM customer""")
def redact(spark, d):
    return apply_policy(inputs.table(spark, d, "customer"), P.REDACT, id_col="c_custkey")


@register("generalize_double", f"""
SELECT c_custkey, {q_label(q_int_of_double('c_acctbal'), [0, 1000, 2500, 5000, 7500])} AS c_acctbal
FROM customer""")
def generalize_double(spark, d):
    return apply_policy(inputs.table(spark, d, "customer"), P.GENERALIZE_DOUBLE, id_col="c_custkey")


@register("generalize_int_and_text", f"""
SELECT p_partkey, {q_label('p_size', [10, 20, 30, 40])} AS p_size,
       {q_label(q_int_of_text('CAST(p_size AS VARCHAR)'), [10, 20, 30, 40])} AS p_size_text,
       {q_label(q_int_of_text('p_brand'), [10, 20, 30, 40])} AS p_brand
FROM part""")
def generalize_int_and_text(spark, d):
    p = inputs.table(spark, d, "part").withColumn("p_size_text", F.col("p_size").cast("string"))
    return apply_policy(p, P.GENERALIZE_INT, id_col="p_partkey")


@register("generalize_long_wrap", f"""
SELECT o_orderkey, {q_label(q_low32('o_orderkey * 4294967296 + o_custkey'), [0, 500, 1000])} AS o_key,
       {q_label(q_int_of_double('o_totalprice'), [100000, 200000, 300000])} AS o_totalprice
FROM orders""")
def generalize_long_wrap(spark, d):
    o = inputs.table(spark, d, "orders").withColumn(
        "o_key", F.col("o_orderkey") * F.lit(4294967296) + F.col("o_custkey"))
    return apply_policy(o, P.GENERALIZE_WRAP, id_col="o_orderkey")


@register("generalize_empty_ranges", """
SELECT p_partkey, CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice, p_type
FROM part""")
def generalize_empty_ranges(spark, d):
    return apply_policy(inputs.table(spark, d, "part"), P.GENERALIZE_NO_RANGES, id_col="p_partkey")


@register("unknown_op_fallback", f"""
SELECT p_partkey, {q_mask_default('p_name')} AS p_name, p_size FROM part""")
def unknown_op_fallback(spark, d):
    return apply_policy(inputs.table(spark, d, "part"), P.UNKNOWN_OP, id_col="p_partkey")


@register("randomize_violations", """
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS bad_text, CAST(0 AS BIGINT) AS bad_int,
       CAST(0 AS BIGINT) AS bad_double
FROM customer""")
def randomize_violations(spark, d):
    c = inputs.table(spark, d, "customer")
    src = c.select("c_custkey", "c_name", "c_nationkey", "c_acctbal",
                   F.col("c_name").alias("o_name"), F.col("c_nationkey").alias("o_nat"),
                   F.col("c_acctbal").alias("o_bal"))
    out = apply_policy(src, P.RANDOMIZE, id_col="c_custkey", keep=["o_name", "o_nat", "o_bal"])
    v_int = F.greatest(F.lit(1.0), F.abs(F.col("o_nat").cast("double")) * 0.2).cast("int")
    v_dbl = F.greatest(F.lit(0.1), F.abs(F.col("o_bal")) * 0.2)
    eps = F.abs(F.col("o_bal")) * 1e-12 + 1e-12
    bad_text = (F.length("c_name") != F.length("o_name")) | ~F.col("c_name").rlike("^[a-zA-Z0-9]*$")
    bad_int = (F.col("c_nationkey") < F.col("o_nat") - v_int) | (F.col("c_nationkey") > F.col("o_nat") + v_int - 1)
    bad_dbl = (F.col("c_acctbal") < F.col("o_bal") - v_dbl - eps) | (F.col("c_acctbal") >= F.col("o_bal") + v_dbl + eps)
    return out.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(bad_text).alias("bad_text"),
                   F.count_if(bad_int).alias("bad_int"), F.count_if(bad_dbl).alias("bad_double"))


@register("randomize_independence", """
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS same_text, CAST(0 AS BIGINT) AS kept_text, CAST(0 AS BIGINT) AS same_ratio,
       CAST(0 AS BIGINT) AS kept_double, true AS few_same_shift, true AS few_kept_int, true AS covers_range
FROM customer""")
def randomize_independence(spark, d):
    """Two fields of a row share no draws: no equal texts or ratios, integers that move alike
    or stay only as often as chance has it, and draws from both ends of the range."""
    c = inputs.table(spark, d, "customer")
    whole = (F.col("c_custkey") % 1000 + 10_000).cast("int")
    src = c.select("c_custkey", F.col("c_name").alias("t1"), F.col("c_name").alias("t2"), whole.alias("i1"), (whole * 2).alias("i2"),
                   (F.abs("c_acctbal") + 100).alias("x1"), ((F.abs("c_acctbal") + 100) * 2).alias("x2"),
                   F.col("c_name").alias("t"), whole.alias("i"), (F.abs("c_acctbal") + 100).alias("x"))
    out = apply_policy(src, P.RANDOMIZE_PAIRS, id_col="c_custkey", keep=["t", "i", "x"])
    shift = F.abs(F.col("i1") / F.col("i") - F.col("i2") / (F.col("i") * 2)) < 1e-3
    n = F.count(F.lit(1))
    return out.agg(n.alias("n_rows"), F.count_if(F.col("t1") == F.col("t2")).alias("same_text"),
                   F.count_if((F.col("t1") == F.col("t")) | (F.col("t2") == F.col("t"))).alias("kept_text"),
                   F.count_if(F.abs(F.col("x1") * 2 - F.col("x2")) < F.col("x") * 1e-9).alias("same_ratio"),
                   F.count_if((F.col("x1") == F.col("x")) | (F.col("x2") == F.col("x") * 2)).alias("kept_double"),
                   (F.count_if(shift) < n * 0.1 + 5).alias("few_same_shift"),
                   (F.count_if(F.col("i1") == F.col("i")) < n * 0.02 + 5).alias("few_kept_int"),
                   ((F.min(F.col("x1") / F.col("x")) < 0.85) & (F.max(F.col("x1") / F.col("x")) > 1.15)).alias("covers_range"))


@register("randomize_whole_text_violations", """
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS bad_length, CAST(0 AS BIGINT) AS bad_chars,
       CAST(sum(length(text)) AS BIGINT) AS n_chars
FROM documents""")
def randomize_whole_text_violations(spark, d):
    docs = inputs.table(spark, d, "documents").select("doc_id", "text", F.length("text").alias("o_len"))
    out = apply_policy(docs, P.DOCUMENTS_RANDOM, id_col="doc_id", keep=["o_len"])
    return out.agg(F.count(F.lit(1)).alias("n_rows"),
                   F.count_if(F.length("text") != F.col("o_len")).alias("bad_length"),
                   F.count_if(~F.col("text").rlike("^[a-zA-Z0-9]*$")).alias("bad_chars"),
                   F.sum(F.length("text").cast("bigint")).alias("n_chars"))


@register("apply_policy_columns", f"""
SELECT c_custkey, {q_hash('c_name')} AS c_name, {q_label('c_nationkey', [0, 5, 10, 15, 20])} AS c_nationkey,
       CAST(NULL AS DOUBLE) AS c_acctbal
FROM customer""")
def apply_policy_columns(spark, d):
    return apply_policy(inputs.table(spark, d, "customer"), P.CUSTOMER_COLUMNS, id_col="c_custkey")


@register("lineitem_policy", f"""
SELECT l_orderkey, l_linenumber, {q_hash('CAST(l_partkey AS VARCHAR)')} AS l_partkey,
       {q_label(q_low32('l_suppkey'), [0, 250, 500, 750])} AS l_suppkey,
       {q_label(q_int_of_double('l_quantity'), [0, 10, 20, 30, 40, 50])} AS l_quantity,
       l_extendedprice, {q_mask_default('l_returnflag')} AS l_returnflag, '[REDACTED]' AS l_linestatus
FROM lineitem""")
def lineitem_policy(spark, d):
    return apply_policy(inputs.table(spark, d, "lineitem"), P.LINEITEM, id_col="l_orderkey", keep=["l_linenumber"]) \
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                "l_returnflag", "l_linestatus")


@register("documents_whole_text", f"""
SELECT doc_id, {q_mask_default('text')} AS text, {q_hash('text')} AS text_hash, lang FROM documents""")
def documents_whole_text(spark, d):
    docs = inputs.table(spark, d, "documents").withColumn("text_hash", F.col("text"))
    return apply_policy(docs, P.DOCUMENTS, id_col="doc_id")


@register("conversations_whole_text", f"""
SELECT conv_id, turn, {q_mask_format('role', 'X***')} AS role, {q_hash('text')} AS text,
       {q_mask_format('text', 'XXXXXXXXXX')} AS text_masked
FROM conversations""")
def conversations_whole_text(spark, d):
    c = inputs.table(spark, d, "conversations").withColumn("text_masked", F.col("text"))
    return apply_policy(c, P.CONVERSATIONS, id_col="conv_id")


@register("pages_whole_text", f"""
SELECT page_id, {q_mask_format('url', 'XXXXXXXX')} AS url, '[REDACTED]' AS html, {q_hash('html')} AS html_hash
FROM pages""")
def pages_whole_text(spark, d):
    p = inputs.table(spark, d, "pages").withColumn("html_hash", F.col("html"))
    return apply_policy(p, P.PAGES, id_col="page_id")


# ---------------------------------------------------------------------------
# JSON text records
# ---------------------------------------------------------------------------
CUSTOMER_JSON_SCHEMA = "id STRING, c_name STRING, c_nationkey STRING, c_acctbal DOUBLE, c_mktsegment STRING"


def _read_back(df: DataFrame, schema: str) -> DataFrame:
    return _read_back_with(df, schema, [])


def _read_back_with(df: DataFrame, schema: str, carry: list[str]) -> DataFrame:
    """Protected JSON text back into columns (one parse), plus the key list in
    output order; ``carry`` columns pass along."""
    v = F.try_parse_json(F.col("value"))
    cols = [c.strip().split(" ") for c in schema.split(",")]
    parsed = df.select(*carry, F.col("value"), F.explode(F.array(v)).alias("__v"))
    return parsed.select(*carry,
                         *[F.try_variant_get(F.col("__v"), f"$['{n}']", t.lower()).alias(n) for n, t in cols],
                         F.array_join(F.json_object_keys(F.col("value")), ",").alias("out_keys"))


@register("apply_policy_json", f"""
SELECT CAST(c_custkey AS VARCHAR) AS id, {q_mask_format('c_name', P.CUSTOMER_FORMAT)} AS c_name,
       {q_label('c_nationkey', [0, 5, 10, 15, 20])} AS c_nationkey, c_acctbal, '[REDACTED]' AS c_mktsegment,
       'id,c_name,c_nationkey,c_acctbal,c_mktsegment' AS out_keys
FROM customer""")
def apply_policy_json_q(spark, d):
    return _read_back(customer_json_out(spark, d), CUSTOMER_JSON_SCHEMA)


@output_of("apply_policy_json")
def customer_json_out(spark, d):
    return apply_policy_json(inputs.customer_json(spark, d), P.CUSTOMER_JSON)


EVENT_JSON_SCHEMA = "id STRING, user_id STRING, event_type STRING, value STRING, props STRING, day STRING"


@register("apply_policy_json_events", f"""
SELECT CAST(event_id AS VARCHAR) AS id, {q_hash('CAST(user_id AS VARCHAR)')} AS user_id,
       {q_mask_format('event_type', P.EVENT_TYPE_FORMAT)} AS event_type,
       CASE WHEN event_type = 'purchase' THEN {q_label(q_int_of_double('value'), [0, 100, 200, 300])} END AS value,
       CAST(json(props) AS VARCHAR) AS props, strftime(ts, '%Y-%m-%d') AS day,
       'id,user_id,event_type,' || CASE WHEN event_type = 'purchase' THEN 'value,' ELSE '' END || 'props,day'
         || CASE WHEN event_type = 'error' THEN ',note' ELSE '' END AS out_keys
FROM events""")
def apply_policy_json_events(spark, d):
    return _read_back(event_json_out(spark, d), EVENT_JSON_SCHEMA)


@output_of("apply_policy_json_events")
def event_json_out(spark, d):
    return apply_policy_json(inputs.event_json(spark, d), P.EVENT_JSON)


ORACLES["apply_rules_table"] = ORACLES["apply_policy_json_events"]


@register("apply_rules_table", None)
def apply_rules_table(spark, d):
    """The same records and rules as ``apply_policy_json_events``, the rules as a table that the fields of the records meet."""
    return _read_back(rules_table_out(spark, d), EVENT_JSON_SCHEMA)


@output_of("apply_rules_table")
def rules_table_out(spark, d):
    return protect_json_by_table(inputs.event_json(spark, d), rules_frame(spark, P.EVENT_JSON))


CONVERSATION_JSON_SCHEMA = "id STRING, role STRING, text STRING, turn STRING"


@register("apply_policy_json_conversations", f"""
SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS id, {q_hash('role')} AS role,
       {q_mask_format('text', 'X' * 20)} AS text, {q_label(q_low32('turn'), [0, 2, 4, 8])} AS turn,
       'id,role,text,turn' AS out_keys
FROM conversations""")
def apply_policy_json_conversations(spark, d):
    """Whole turn texts inside JSON records: escaping, masking and hashing of long text."""
    return _read_back(conversation_json_out(spark, d), CONVERSATION_JSON_SCHEMA)


@output_of("apply_policy_json_conversations")
def conversation_json_out(spark, d):
    return apply_policy_json(inputs.conversation_json(spark, d), P.CONVERSATION_JSON)


KEEP_ALL_SCHEMA = "id STRING, user_id BIGINT, event_type STRING, value DOUBLE, day STRING, props STRING"


@register("keep_all_json", """
SELECT CAST(event_id AS VARCHAR) AS id, user_id, event_type,
       CASE WHEN event_type = 'purchase' THEN value END AS value, strftime(ts, '%Y-%m-%d') AS day,
       CAST(json(props) AS VARCHAR) AS props,
       'id,day,event_type,' || CASE WHEN event_type = 'error' THEN 'note,' ELSE '' END || 'props,ts,user_id'
         || CASE WHEN event_type = 'purchase' THEN ',value' ELSE '' END AS out_keys
FROM events""")
def keep_all_json_q(spark, d):
    return _read_back(keep_all_out(spark, d), KEEP_ALL_SCHEMA)


@output_of("keep_all_json")
def keep_all_out(spark, d):
    return keep_all_json(inputs.event_json(spark, d))


@register("reject_split", """
SELECT CASE WHEN event_type = 'error' THEN 'parse_error' WHEN value >= 1 THEN 'ok' ELSE 'missing_id' END AS status,
       count(*) AS n
FROM events GROUP BY 1""")
def reject_split(spark, d):
    res = protect_json(inputs.event_json_with_faults(spark, d), P.EVENT_FAULTS)
    return res.groupBy(F.coalesce(F.col("reason"), F.lit("ok")).alias("status")).agg(F.count(F.lit(1)).alias("n"))


@register("reject_reasons", """
SELECT CASE event_id % 7 WHEN 1 THEN 'parse_error' WHEN 2 THEN 'too_deep' WHEN 3 THEN 'long_number' WHEN 4 THEN 'parse_error'
                         WHEN 6 THEN 'missing_id' ELSE 'ok' END AS status, count(*) AS n
FROM events GROUP BY 1""")
def reject_reasons(spark, d):
    """Every reason for a rejection, also where a record looks like another one: brackets side by side, digits in strings."""
    res = protect_json(inputs.event_json_with_limits(spark, d), P.EVENT_FAULTS)
    return res.groupBy(F.coalesce(F.col("reason"), F.lit("ok")).alias("status")).agg(F.count(F.lit(1)).alias("n"))


@register("run_metrics", """
SELECT count(*) AS records_in, CAST(count_if(event_type <> 'error' AND value >= 1) AS BIGINT) AS records_out,
       CAST(count_if(NOT (event_type <> 'error' AND value >= 1)) AS BIGINT) AS records_rejected
FROM events""")
def run_metrics(spark, d):
    res = protect_json(inputs.event_json_with_faults(spark, d), P.EVENT_FAULTS)
    return res.agg(*count_columns("reason"))


@register("metrics_sketches", """
SELECT CAST(count(*) AS BIGINT) AS n_rows, true AS ids_close, true AS quartiles_close FROM orders""")
def metrics_sketches(spark, d):
    """Distinct customers and quartiles of the price from one sketch row a month, against the exact figures: 3 % and 3 % of the ranks."""
    o = inputs.table(spark, d, "orders")
    rows = o.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("batch")).agg(*sketch_columns("o_custkey", "o_totalprice"))
    u = united(rows)
    exact = o.agg(F.count_distinct("o_custkey").alias("exact_ids"), F.percentile("o_totalprice", [0.22, 0.28, 0.47, 0.53, 0.72, 0.78]).alias("near"))
    q, near = F.col("quartiles"), F.col("near")
    both = u.select(F.lit(1).alias("one"), "n_rows", "n_ids", F.col("quantiles").alias("quartiles")).join(exact.withColumn("one", F.lit(1)), "one")  # a row each
    close = [(q[i] >= near[2 * i]) & (q[i] <= near[2 * i + 1]) for i in range(3)]
    return both.select("n_rows", (F.abs(F.col("n_ids") - F.col("exact_ids")) <= F.col("exact_ids") * 0.03).alias("ids_close"),
                       (close[0] & close[1] & close[2]).alias("quartiles_close"))


# ---------------------------------------------------------------------------
# drift, type profile, validation
# ---------------------------------------------------------------------------
@register("undefined_field_drift", """
SELECT 'value' AS field, count(*) AS n_records FROM events WHERE event_type = 'purchase'
UNION ALL SELECT 'day', count(*) FROM events
UNION ALL SELECT 'ts', count(*) FROM events
UNION ALL SELECT 'props', count(*) FROM events
UNION ALL SELECT 'note', count(*) FROM events WHERE event_type = 'error'""")
def undefined_field_drift(spark, d):
    return drift.drift_report(inputs.event_json(spark, d), P.EVENT_DECLARED)


@register("field_inventory", """
SELECT k AS field, count(*) AS n_records,
       k IN ('id', 'user_id', 'event_type', 'value', 'props', 'day', 'note') AS declared,
       k IN ('user_id', 'event_type', 'value', 'day', 'note') AS is_pii,
       CASE k WHEN 'user_id' THEN 'hash' WHEN 'event_type' THEN 'mask' WHEN 'value' THEN 'generalize'
              WHEN 'day' THEN 'mask' WHEN 'note' THEN 'redact' END AS operation
FROM (SELECT 'id' AS k FROM events
      UNION ALL SELECT 'user_id' FROM events UNION ALL SELECT 'event_type' FROM events
      UNION ALL SELECT 'value' FROM events WHERE event_type = 'purchase'
      UNION ALL SELECT 'day' FROM events UNION ALL SELECT 'ts' FROM events
      UNION ALL SELECT 'props' FROM events UNION ALL SELECT 'note' FROM events WHERE event_type = 'error')
GROUP BY k""")
def field_inventory(spark, d):
    return drift.field_inventory(inputs.event_json(spark, d), P.EVENT_JSON)


@register("type_profile_json", """
SELECT 'user_id' AS field, 'INT' AS sql_type, count(*) AS n_values FROM events
UNION ALL SELECT 'event_type', 'STRING', count(*) FROM events
UNION ALL SELECT 'value', 'DOUBLE', count(*) FROM events WHERE event_type = 'purchase'
UNION ALL SELECT 'day', 'STRING', count(*) FROM events
UNION ALL SELECT 'ts', 'STRING', count(*) FROM events
UNION ALL SELECT 'props', 'STRING', count(*) FROM events
UNION ALL SELECT 'note', 'STRING', count(*) FROM events WHERE event_type = 'error'""")
def type_profile_json(spark, d):
    return drift.type_profile(inputs.event_json(spark, d))


@register("type_profile_mixed", """
SELECT 'm' AS field, CASE event_id % 7 WHEN 0 THEN 'INT' WHEN 1 THEN 'BIGINT' WHEN 2 THEN 'DOUBLE' WHEN 3 THEN 'BOOLEAN' ELSE 'STRING' END AS sql_type,
       count(*) AS n_values
FROM events WHERE event_id % 7 < 6 GROUP BY 1, 2""")
def type_profile_mixed(spark, d):
    return drift.type_profile(inputs.mixed_json(spark, d))


@register("type_profile_table", """
SELECT 'o_orderkey' AS field, 'BIGINT' AS sql_type, count(o_orderkey) AS n_values FROM orders
UNION ALL SELECT 'o_custkey', 'BIGINT', count(o_custkey) FROM orders
UNION ALL SELECT 'o_orderstatus', 'STRING', count(o_orderstatus) FROM orders
UNION ALL SELECT 'o_totalprice', 'DOUBLE', count(o_totalprice) FROM orders
UNION ALL SELECT 'o_orderdate', 'TIMESTAMP(3)', count(o_orderdate) FROM orders
UNION ALL SELECT 'o_orderpriority', 'STRING', count(o_orderpriority) FROM orders""")
def type_profile_table(spark, d):
    return drift.table_type_profile(inputs.table(spark, d, "orders"))


@register("validate_fields", """
SELECT 'id' AS field, count(*) AS n_valid, CAST(0 AS BIGINT) AS n_invalid FROM customer
UNION ALL SELECT 'c_name', count(*), 0 FROM customer
UNION ALL SELECT 'c_nationkey', count(*), 0 FROM customer
UNION ALL SELECT 'c_acctbal', 0, count(*) FROM customer
UNION ALL SELECT 'c_mktsegment', 0, count(*) FROM customer
UNION ALL SELECT 'c_phone', count(*), 0 FROM customer""")
def validate_fields_q(spark, d):
    checked = validate.validate_fields(inputs.customer_json(spark, d), P.CUSTOMER_VALIDATION)
    return validate.validation_summary(checked)


# the kinds of the member by event_id % 7 that each declared type accepts besides null (4) and absent (6)
MIXED_ACCEPTED = {"string": "5", "integer": "0, 1", "double": "2", "boolean": "3", "date": "0, 1, 2, 3, 5"}


@register("validate_mixed", "\nUNION ALL ".join(
    f"SELECT '{t}{end}' AS field, count(*) FILTER (ok) AS n_valid, count(*) FILTER (NOT ok) AS n_invalid "
    f"FROM (SELECT event_id % 7 IN ({MIXED_ACCEPTED[t]}, 6{'' if end else ', 4'}) AS ok FROM events)"
    for t in P.MIXED_TYPES for end in ("", "_required")))
def validate_mixed(spark, d):
    records = inputs.mixed_json(spark, d, tuple(r.name for r in P.MIXED_VALIDATION.rules))
    return validate.validation_summary(validate.validate_fields(records, P.MIXED_VALIDATION))


@register("validate_sizes", """
SELECT 'role' AS field, count(*) FILTER (n <= 6) AS n_valid, count(*) FILTER (n > 6) AS n_invalid
FROM (SELECT coalesce(length(role), 0) AS n FROM conversations)
UNION ALL SELECT 'text', count(*) FILTER (n <= 120), count(*) FILTER (n > 120)
FROM (SELECT coalesce(length(text), 0) AS n FROM conversations)
UNION ALL SELECT 'turn', count(*), 0 FROM conversations""")
def validate_sizes(spark, d):
    checked = validate.validate_fields(inputs.conversation_json(spark, d), P.TURN_SIZES, sizes=True)
    return validate.validation_summary(checked)


# ---------------------------------------------------------------------------
# policy versions, lake tables
# ---------------------------------------------------------------------------
@register("policy_asof", f"""
SELECT event_id, v AS policy_version,
       CASE v WHEN 1 THEN {q_mask_default('event_type')} WHEN 2 THEN {q_hash('event_type')}
              ELSE '[REDACTED]' END AS event_type,
       CASE v WHEN 1 THEN {q_hash('CAST(user_id AS VARCHAR)')}
              WHEN 2 THEN {q_label(q_low32('user_id'), [0, 500, 1000])} END AS user_id
FROM (SELECT *, CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN 3 WHEN ts >= TIMESTAMP '2024-01-10' THEN 2
                     ELSE 1 END AS v
      FROM events WHERE ts >= TIMESTAMP '2024-01-01')""")
def policy_asof(spark, d):
    return apply_policy_asof(inputs.table(spark, d, "events"), P.ASOF_VERSIONS, "ts", id_col="event_id")


ASOF_JSON_SCHEMA = "id STRING, event_type STRING, user_id STRING"


@register("policy_asof_json", f"""
SELECT CAST(event_id AS VARCHAR) AS id, v AS policy_version,
       CASE v WHEN 1 THEN {q_mask_default('event_type')} WHEN 2 THEN {q_hash('event_type')}
              ELSE '[REDACTED]' END AS event_type,
       CASE v WHEN 1 THEN {q_hash('CAST(user_id AS VARCHAR)')}
              WHEN 2 THEN {q_label(q_low32('user_id'), [0, 500, 1000])} END AS user_id,
       CASE WHEN v < 3 THEN 'id,event_type,user_id' ELSE 'id,event_type' END AS out_keys
FROM (SELECT *, CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN 3 WHEN ts >= TIMESTAMP '2024-01-10' THEN 2
                     ELSE 1 END AS v
      FROM events WHERE ts >= TIMESTAMP '2024-01-01')""")
def policy_asof_json(spark, d):
    return _read_back_with(asof_json_out(spark, d), ASOF_JSON_SCHEMA, ["policy_version"])


@output_of("policy_asof_json")
def asof_json_out(spark, d):
    res = protect_json_asof(inputs.event_json(spark, d, with_ts=True), P.ASOF_VERSIONS, F.col("ts"))
    return res.where(F.col("reason").isNull())


@register("policy_asof_table", f"""
WITH e AS (SELECT *, user_id % 20 AS tenant FROM events),
v AS (SELECT tenant, ts AS valid_from, max(event_id) AS label FROM e WHERE event_id % 5 = 0 AND ts >= TIMESTAMP '2024-01-03' GROUP BY ALL),
j AS (SELECT e.*, v.label, 10 + v.label % 90 AS high FROM e ASOF LEFT JOIN v ON e.tenant = v.tenant AND e.ts >= v.valid_from)
SELECT event_id, label AS policy_version,
       CASE label % 4 WHEN 0 THEN {q_mask_default('event_type')} WHEN 1 THEN {q_mask_format('event_type', 'X*xX')} WHEN 2 THEN {q_hash('event_type')}
                      WHEN 3 THEN '[REDACTED]' END AS event_type,
       CASE WHEN label % 3 = 0 THEN NULL WHEN label % 3 = 1 THEN CAST(user_id AS VARCHAR)
            WHEN user_id < 0 THEN '<0' WHEN user_id < high THEN '0-' || high ELSE high || '+' END AS user_id,
       CASE WHEN label IS NULL THEN 'no_policy' END AS reason
FROM j""")
def policy_asof_table(spark, d):
    """Events of 20 tenants under a table of policy versions, a fifth as many as there are events: rules, formats and ranges are data."""
    e = inputs.table(spark, d, "events").select("event_id", "ts", "event_type", "user_id").withColumn("tenant", F.col("user_id") % 20)
    turn = F.col("event_id") % 4
    op = F.when(turn < 2, "mask").when(turn == 2, "hash").otherwise("redact")
    none, no_ranges = F.lit(None).cast("string"), F.array().cast("array<int>")
    text = F.struct(F.lit(True), op, F.lit("string"), F.when(turn == 1, F.lit("X*xX")).otherwise(none), no_ranges).cast(RULE)
    number = F.struct(F.col("event_id") % 3 == 2, F.lit("generalize"), F.lit("integer"), none, F.array(F.lit(0), (F.col("event_id") % 90 + 10).cast("int"))).cast(RULE)
    rules = F.when(F.col("event_id") % 3 == 0, F.create_map(F.lit("event_type"), text)).otherwise(F.create_map(F.lit("event_type"), text, F.lit("user_id"), number))
    versions = (e.where((F.col("event_id") % 5 == 0) & (F.col("ts") >= F.lit("2024-01-03 00:00:00").cast("timestamp_ntz")))
                .select("tenant", F.col("ts").alias("valid_from"), F.col("event_id").alias("label"), rules.alias("rules")))
    return protect_asof_table(e, versions, ["tenant"], "ts", ["event_type", "user_id"], tie=["label"], keep=["event_id"])


@register("enrich_events", f"""
SELECT CAST(event_id AS VARCHAR) AS id, {q_hash('CAST(user_id AS VARCHAR)')} AS user_id,
       {q_mask_format('event_type', P.EVENT_TYPE_FORMAT)} AS event_type,
       CASE WHEN event_type = 'purchase' THEN {q_label(q_int_of_double('value'), [0, 100, 200, 300])} END AS value,
       CAST(json(props) AS VARCHAR) AS props, strftime(ts, '%Y-%m-%d') AS day, CAST(NULL AS VARCHAR) AS note,
       strftime(ts, '%Y-%m-%d') AS event_date_prt
FROM events""")
def enrich_events(spark, d):
    """Protected event records as typed columns with the daily partition (the
    enrichment step before the upsert; processing time left out)."""
    raw = inputs.event_json(spark, d)
    e = enrich_frame(apply_policy_json(raw, P.EVENT_JSON), event_time_field="day", event_time_format="yyyy-MM-dd",
                     types=lake.protected_types(raw, P.EVENT_JSON))
    return e.select("id", "user_id", "event_type", "value", "props", "day", "note",
                    F.date_format(lake.PARTITION_COL, "yyyy-MM-dd").alias(lake.PARTITION_COL))


@register("time_columns_partition", """
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS event_date_prt, count(*) AS n FROM events GROUP BY 1""")
def time_columns_partition(spark, d):
    """Rows per daily partition (the day as ``yyyy-MM-dd`` text, as in the folder names)."""
    e = lake.add_time_columns(inputs.table(spark, d, "events"), "ts")
    return e.groupBy(F.date_format(lake.PARTITION_COL, "yyyy-MM-dd").alias(lake.PARTITION_COL)) \
        .agg(F.count(F.lit(1)).alias("n"))


@register("upsert_latest", """
SELECT user_id, event_id, ts, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""")
def upsert_latest(spark, d):
    e = inputs.table(spark, d, "events").select("user_id", "event_id", "ts", "event_type", "value", "props")
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return lake.upsert_latest(e.where(F.col("ts") < cut), e.where(F.col("ts") >= cut),
                              "user_id", ["ts", "event_id"])


@register("merge_table", """
WITH e AS (SELECT CASE WHEN event_id % 89 <> 0 THEN user_id END AS user_id, event_id, CASE WHEN event_id % 97 <> 0 THEN ts END AS ts, event_type, value FROM events),
r AS (SELECT *, CASE WHEN user_id IS NULL THEN 1 ELSE row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) END AS n FROM e)
SELECT user_id, event_id, event_type, CASE WHEN event_id % 2 = 0 THEN floor(value) ELSE value END AS amount,
       CASE WHEN event_id % 2 = 0 THEN '' ELSE 'm' END || CAST(event_id AS VARCHAR) AS mark,
       CASE WHEN event_id % 2 = 0 THEN CAST(9007199254740993 + event_id AS VARCHAR) ELSE CAST(floor(value) + 0.5 AS VARCHAR) END AS large,
       CASE WHEN event_id % 2 = 1 THEN event_type END AS extra, strftime(ts, '%Y-%m-%d') AS event_date_prt
FROM r WHERE n = 1""")
def merge_table(spark, d):
    """Two merges into a daily table: keys that move between days, rows without a day or a key, a
    new field, a number that becomes a double, one that becomes text and whole numbers that no double holds."""
    e = inputs.table(spark, d, "events").withColumns({"ts": F.when(F.col("event_id") % 97 != 0, F.col("ts")),
                                                      "user_id": F.when(F.col("event_id") % 89 != 0, F.col("user_id"))})
    even = F.col("event_id") % 2 == 0
    first = e.where(even).select("user_id", "event_id", "ts", "event_type", F.floor("value").cast("bigint").alias("amount"), F.col("event_id").alias("mark"),
                                 (F.col("event_id") + F.lit(9007199254740993)).alias("large"))
    second = e.where(~even).select("user_id", "event_id", "ts", "event_type", F.col("value").alias("amount"),
                                   F.concat(F.lit("m"), F.col("event_id").cast("string")).alias("mark"),
                                   (F.floor("value") + F.lit(0.5)).cast("double").alias("large"), F.col("event_type").alias("extra"))
    path = scratch_dir(spark, f"daily-table-{uuid.uuid4().hex}")
    for part in (first, second):
        lake.merge_evolving(spark, path, lake.add_time_columns(part, "ts").drop(lake.PROCESSING_TS), "user_id", ["ts", "event_id"])
    return lake.read_table(spark, path).select("user_id", "event_id", "event_type", "amount", "mark", "large", "extra",
                                               F.date_format(lake.PARTITION_COL, "yyyy-MM-dd").alias(lake.PARTITION_COL))


@register("merge_partitions", """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events),
l AS (SELECT user_id, event_id, event_type, ts FROM r WHERE n = 1)
SELECT 'hour' AS strategy, user_id, event_id, event_type, strftime(ts, '%Y-%m-%d-%H') AS event_date_prt FROM l
UNION ALL SELECT 'bucket:8', user_id, event_id, event_type, 'one of 8' FROM l""")
def merge_partitions(spark, d):
    """Two merges of events by user into tables with other partition strategies; keys move between hours."""
    e = inputs.table(spark, d, "events").select("user_id", "event_id", "ts", "event_type")
    out = None
    for strategy in ("hour", "bucket:8"):
        path = scratch_dir(spark, f"table-{strategy.replace(':', '')}-{uuid.uuid4().hex}")
        for i in range(2):
            part = lake.add_time_columns(e.where(F.col("event_id") % 2 == i), "ts", strategy, "user_id").drop(lake.PROCESSING_TS)
            lake.merge_into(spark, path, part, "user_id", ["ts", "event_id"])
        value = F.col(lake.PARTITION_COL).cast("string")
        if strategy.startswith("bucket"):
            value = F.when(value.cast("int").between(0, 7), F.lit("one of 8"))
        t = lake.read_table(spark, path).select(F.lit(strategy).alias("strategy"), "user_id", "event_id", "event_type", value.alias(lake.PARTITION_COL))
        out = t if out is None else out.unionByName(t)
    return out


@register("enrich_batches", f"""
WITH e AS (SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day DESC, CAST(event_id AS VARCHAR) DESC) AS n FROM e)
SELECT CAST(event_id AS VARCHAR) AS id, {q_hash('CAST(user_id AS VARCHAR)')} AS user_id,
       {q_mask_format('event_type', P.EVENT_TYPE_FORMAT)} AS event_type,
       CASE WHEN event_type = 'purchase' THEN {q_label(q_int_of_double('value'), [0, 100, 200, 300])} END AS value,
       CAST(json(props) AS VARCHAR) AS props, day, CAST(NULL AS VARCHAR) AS note, day AS event_date_prt
FROM r WHERE n = 1""")
def enrich_batches(spark, d):
    """Protected events through the enrichment job in three batches: the newest record of every user, types from the policy."""
    raw = inputs.event_json(spark, d)
    table = scratch_dir(spark, f"enriched-{uuid.uuid4().hex}")
    job = EnrichStream(spark, table, key="user_id", order=(lake.EVENT_DATE, "id"), event_time_field="day", event_time_format="yyyy-MM-dd", policy=P.EVENT_JSON)
    turn = F.pmod(F.xxhash64("value"), F.lit(3))
    for i in range(3):
        job.process(apply_policy_json(raw.where(turn == i), P.EVENT_JSON), i)
    return lake.read_table(spark, table).select("id", "user_id", "event_type", "value", "props", "day", "note",
                                                F.date_format(lake.PARTITION_COL, "yyyy-MM-dd").alias(lake.PARTITION_COL))


@register("fields_open", """
SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id, event_type AS kind, CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS own,
       CASE WHEN event_id % 3 = 0 THEN '{"at":' || CAST(event_id AS VARCHAR) || '}' END AS place, true AS few_columns
FROM events""")
def fields_open(spark, d):
    """Records with a field named by the user's id: a bounded number of columns, all others in a map, every value read back by its name."""
    e = inputs.table(spark, d, "events")
    fixed = F.to_json(F.struct(F.col("event_id").alias("id"), "user_id", F.col("event_type").alias("kind")))
    own = F.to_json(F.create_map(F.concat(F.lit("u"), F.col("user_id").cast("string")), F.floor("value").cast("bigint")))
    place = F.when(F.col("event_id") % 3 == 0, F.to_json(F.struct(F.struct(F.col("event_id").alias("at")).alias("place"))))
    inner = lambda c: F.expr(f"substring({c}, 2, length({c}) - 2)")
    parts = e.select(fixed.alias("a"), own.alias("b"), place.alias("c")).select(F.concat_ws(",", inner("a"), inner("b"), inner("c")).alias("body"))
    rows = parts.select(F.concat(F.lit("{"), "body", F.lit("}")).alias("value"))
    table = scratch_dir(spark, f"fields-open-{uuid.uuid4().hex}")
    job = EnrichStream(spark, table, max_fields=5)
    turn = F.pmod(F.xxhash64("value"), F.lit(2))
    for i in range(2):
        job.process(rows.where(turn == i), i)
    t = lake.read_table(spark, table)
    few = len(lake.field_columns(t.schema)) <= 5
    m = t.select(fields_map(t).alias("m"))
    return m.select(F.col("m")["id"].alias("id"), F.col("m")["user_id"].alias("user_id"), F.col("m")["kind"].alias("kind"),
                    F.col("m")[F.concat(F.lit("u"), F.col("m")["user_id"])].alias("own"), F.col("m")["place"].alias("place"), F.lit(few).alias("few_columns"))


@register("evolve_union", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, CAST(NULL AS VARCHAR) AS c_tier FROM customer
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, c_mktsegment || '-T' AS c_tier FROM customer""")
def evolve_union(spark, d):
    c = inputs.table(spark, d, "customer")
    return lake.evolve_union(c, c.withColumn("c_tier", F.concat(F.col("c_mktsegment"), F.lit("-T"))))


@register("field_watch", """
WITH closed AS (SELECT *, date_trunc('day', ts) AS day FROM events
                WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR),
f AS (SELECT 'user_id' AS field, 'INT' AS sql_type, ts, day FROM closed
      UNION ALL SELECT 'event_type', 'STRING', ts, day FROM closed
      UNION ALL SELECT 'value', 'DOUBLE', ts, day FROM closed WHERE event_type = 'purchase'
      UNION ALL SELECT 'day', 'STRING', ts, day FROM closed
      UNION ALL SELECT 'ts', 'STRING', ts, day FROM closed
      UNION ALL SELECT 'props', 'STRING', ts, day FROM closed
      UNION ALL SELECT 'note', 'STRING', ts, day FROM closed WHERE event_type = 'error'),
w AS (SELECT field, sql_type, day, count(*) AS n_window, min(ts) AS first_seen, max(ts) AS last_seen FROM f GROUP BY ALL)
SELECT field, sql_type, strftime(day, '%Y-%m-%d') AS day, n_window, CAST(sum(n_window) OVER p AS BIGINT) AS n_total,
       CASE WHEN row_number() OVER p = 1 THEN 'new_field' ELSE 'seen' END AS event,
       epoch_us(min(first_seen) OVER p) AS first_us, epoch_us(max(last_seen) OVER p) AS last_us
FROM w WINDOW p AS (PARTITION BY field ORDER BY day)""")
def field_watch(spark, d):
    """First-seen times and counts of the fields of event records as a stream's state, over two runs of the query: the events before a day and the rest."""
    home = scratch_dir(spark, f"field-watch-{uuid.uuid4().hex}")
    e = inputs.event_json(spark, d, with_ts=True)
    before = F.col("ts") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    watch = FieldWatch(spark, f"{home}/report", "ts")
    for part in (before, ~before):
        e.where(part).write.mode("append").parquet(f"{home}/in")
        watch.run(spark.readStream.schema(e.schema).parquet(f"{home}/in"), f"{home}/checkpoint")
    return watch.events().select("field", "sql_type", F.date_format("window_start", "yyyy-MM-dd").alias("day"), "n_window", "n_total", "event",
                                 F.unix_micros("first_seen").alias("first_us"), F.unix_micros("last_seen").alias("last_us"))


# The pads of a key: its bytes xor-ed with a constant; the secrets here are 64 hexadecimal digits, so all of them stay ASCII.
def q_pad(secret: str, byte: int) -> str:
    return f"array_to_string([chr(xor(ascii(substr({secret}, i, 1)), {byte})) FOR i IN range(1, 65)], '')"


def q_keyed(text: str) -> str:
    inner = f"unhex(sha256(inner_pad || {text}))"
    return f"key_id || ':' || base64(unhex(sha256(encode(outer_pad) || {inner})))"


@register("hash_rotated", f"""
WITH s AS (SELECT date_trunc('week', ts) AS week, sha256(strftime(date_trunc('week', ts), '%Y-%m-%d')) AS secret FROM events GROUP BY 1),
k AS (SELECT 'k' || strftime(week, '%Y%m%d') AS key_id, week, {q_pad('secret', 0x36)} AS inner_pad, {q_pad('secret', 0x5C)} AS outer_pad FROM s),
e AS (SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, event_type, ts, date_trunc('week', ts) AS week FROM events)
SELECT event_id, event_type, CASE WHEN dayofweek(ts) <> 0 THEN {q_keyed('user_id')} END AS hashed,
       CASE WHEN dayofweek(ts) = 0 THEN 'no_key' END AS reason, CASE WHEN dayofweek(ts) <> 0 THEN true END AS verified
FROM e JOIN k USING (week)""")
def hash_rotated(spark, d):
    """Event records hashed under a table of weekly keys, each valid until Sunday: hashes name their key, records of Sundays have none and
    are rejected, and every hash is verified under the key that it names."""
    e = inputs.table(spark, d, "events")
    week = F.date_trunc("week", F.col("ts").cast("timestamp"))
    weeks = e.select(week.alias("valid_from")).distinct()
    made = weeks.select(F.concat(F.lit("k"), F.date_format("valid_from", "yyyyMMdd")).alias("key_id"),
                        F.encode(F.sha2(F.date_format("valid_from", "yyyy-MM-dd"), 256), "UTF-8").alias("secret"), "valid_from",
                        (F.col("valid_from") + F.expr("INTERVAL 6 DAYS")).alias("valid_to"))
    path = scratch_dir(spark, f"keys-{uuid.uuid4().hex}")
    made.write.parquet(path)
    table = spark.read.parquet(path)
    doc = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("user_id").cast("string").alias("user_id"), "event_type"))
    records = e.select("event_id", F.col("user_id").cast("string").alias("user"), "event_type", "ts", doc.alias("value"))
    out = keys.protect_json_keyed(records, P.KEYED_JSON, table, "ts", keep=["event_id", "user", "event_type"])
    out = out.withColumn("hashed", F.get_json_object("value", "$.user_id"))
    return keys.verify(out, "hashed", "user", table).select("event_id", "event_type", "hashed", "reason", "verified")
