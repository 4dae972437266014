"""Registered queries of the operators: each applies one to its whole table.

``QUERIES`` maps a name to ``f(spark, sf_dir)``; ``ORACLES`` holds SQL where
SQL can express the result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.llm import (bpe, exact_dedup, filter_audit, lattice, merkle, mixing, near_dedup, permutation_index, positional_index, quality,
                           sanitise, sharding, toxicity)
from veilspark.llm.common import id_bucket, table

SHARDS = 24


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_components(table(spark, sf_dir, "documents"), k=2, percent=80)


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return m.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.score_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard_rows(docs, SHARDS).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return permutation_index.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.token_digests(bpe.bpe_encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.classify(docs, model, ["doc_id"])


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.span_digests(sanitise.find_spans(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op11_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = positional_index.contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), table(spark, sf_dir, "labels"))


def op13_merkle_proofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tampering: in rows whose id's crc32 is divisible by 3, the text's A-Z are lower-cased."""
    docs = table(spark, sf_dir, "documents").select(*merkle.LEAF_COLUMNS)
    lowered = F.translate("text", positional_index.CAPITALS, positional_index.SMALL)
    return merkle.check_leaves(docs, {"text": lowered}, id_bucket("doc_id", 3) == 0)


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_exact_dedup, op3_near_dedup, op4_mix_sources, op5_lm_score, op6_shard, op7_nearest, op8_bpe,
                                  op9_quality, op10_pii, op11_contamination, op12_filter_audit, op13_merkle_proofs)}

LOWER = f"translate(coalesce(text, ''), '{positional_index.CAPITALS}', '{positional_index.SMALL}')"



def _merkle_sql(levels: int = 8, top_levels: int = 3) -> str:
    """Level by level, for up to 8 ** levels rows of a language and 8 ** top_levels languages; a tree that is one node stays as it is."""
    def value(c: str) -> str:
        text = f"CAST({c} AS VARCHAR)"
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE CAST(strlen({text}) AS VARCHAR) || ':' || {text} END"

    def tree(prefix: str, names: str, n: int) -> list[str]:
        """Nodes of level i + 1 and the siblings of level i; a level whose tree is done has none and hashes nothing."""
        out = []
        for i in range(n):
            out.append(f"{prefix}{i + 1} AS (SELECT {names}, pos // 8 AS pos, (any_value(n) + 7) // 8 AS n, "
                       f"CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h FROM {prefix}{i} GROUP BY {names}, pos // 8)")
            run = f"PARTITION BY {names}, pos // 8 ORDER BY pos"
            out.append(f"{prefix}s{i} AS (SELECT {names}, pos, n > 1 AS live, "
                       f"coalesce(string_agg(h, '') OVER ({run} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
                       f"coalesce(string_agg(h, '') OVER ({run} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {prefix}{i})")
        return out

    fields = " || ".join(value(c) for c in merkle.LEAF_COLUMNS)
    lowered = fields.replace(value("text"), value(f"translate(text, '{positional_index.CAPITALS}', '{positional_index.SMALL}')"))
    # CRC-32 has no function in SQL here: bit by bit, as the check value's rule has it
    ctes = [
        """crc AS (SELECT doc_id, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
            lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                                  lambda v, u: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)) AS c
           FROM (SELECT DISTINCT doc_id FROM documents))""",
        f"leaves AS (SELECT doc_id, coalesce('1' || lang, '0') AS p, sha256({fields}) AS leaf, "
        f"CASE WHEN xor(c, 4294967295) % 3 = 0 THEN sha256({lowered}) ELSE sha256({fields}) END AS told FROM documents JOIN crc USING (doc_id))",
        "numbered AS (SELECT *, row_number() OVER (PARTITION BY p ORDER BY doc_id, leaf) - 1 AS pos, count(*) OVER (PARTITION BY p) AS n FROM leaves)",
        "n0 AS (SELECT p, pos, n, leaf AS h FROM numbered)", *tree("n", "p", levels),
        f"t0 AS (SELECT 1 AS one, p, row_number() OVER (ORDER BY p) - 1 AS pos, count(*) OVER () AS n, h FROM n{levels})", *tree("t", "one", top_levels),
        f"m0 AS (SELECT x.doc_id, x.p, x.pos, leaf, subs.pos AS top, subs.h AS subroot, t{top_levels}.h AS root, '' AS proof, told AS fold "
        f"FROM numbered x JOIN t0 subs USING (p), t{top_levels})",
    ]
    steps = [(f"ns{i}", f"s.p = m.p AND s.pos = m.pos // {8 ** i}") for i in range(levels)] + [(f"ts{i}", f"s.pos = m.top // {8 ** i}") for i in range(top_levels)]
    for k, (name, on) in enumerate(steps):
        ctes.append(f"m{k + 1} AS (SELECT m.doc_id, m.p, m.pos, leaf, top, subroot, root, CASE WHEN live THEN proof || l || r ELSE proof END AS proof, "
                    f"CASE WHEN live THEN sha256(l || fold || r) ELSE fold END AS fold FROM m{k} m JOIN {name} s ON {on})")
    return (f"WITH {', '.join(ctes)} SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = root AS verified "
            f"FROM m{len(steps)}")


ORACLES = {
    "op2_exact_dedup": r"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
        g AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
        FROM t JOIN g USING (body)""",
    "op11_contamination": rf"""
        WITH d AS (SELECT doc_id, hash(text) AS h, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        i AS (SELECT item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        windows AS (SELECT DISTINCT item_id, w[s:s + 9] AS win FROM (SELECT *, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s FROM i WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT len(win) AS n FROM windows),
        places AS (SELECT doc_id, h, s, w[s:s + n - 1] AS win, n
                   FROM (SELECT *, unnest(generate_series(1, len(w) - n + 1)) AS s FROM d, sizes WHERE len(w) >= n)),
        hits AS (SELECT doc_id, h, s, n, item_id FROM places JOIN windows USING (win)),
        covered AS (SELECT doc_id, h, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, h, unnest(generate_series(s, s + n - 1)) AS p FROM hits) GROUP BY ALL),
        found AS (SELECT doc_id, h, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                  FROM (SELECT DISTINCT doc_id, h, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY ALL)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN covered USING (doc_id, h) LEFT JOIN found USING (doc_id, h)""",
    "op12_filter_audit": r"""
        WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        flags AS (SELECT doc_id, part, len(w) < 100 AS a, 100 * len(list_distinct(w)) < 80 * len(w) AS b,
                         100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 10 * length(body) AS c, regexp_matches(body, '[#$%&*|]') AS d,
                         coalesce(doc_id > min(doc_id) OVER (PARTITION BY body), false) AS e FROM t),
        masks AS (SELECT doc_id, part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask FROM flags),
        marks AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
        cells AS (SELECT part, mask, count(*) AS n, count_if(coalesce(good, false)) AS good, count_if(coalesce(toxic, false)) AS toxic
                  FROM masks LEFT JOIN marks USING (doc_id) GROUP BY part, mask),
        letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
        orders AS (SELECT v.f || w.f || x.f || y.f || z.f AS filter_order FROM letters v, letters w, letters x, letters y, letters z
                   WHERE v.bit + w.bit + x.bit + y.bit + z.bit = 31 AND (v.bit | w.bit | x.bit | y.bit | z.bit) = 31),
        steps AS (SELECT filter_order, step, bit, CAST((SELECT sum(l.bit) FROM letters l WHERE contains(left(filter_order, step - 1), l.f)) AS BIGINT) AS before
                  FROM (SELECT *, unnest([1, 2, 3, 4, 5]) AS step FROM orders) JOIN letters ON f = substr(filter_order, step, 1)),
        counts AS (SELECT part, filter_order, step, bit,
                          sum(CASE WHEN mask & (coalesce(before, 0) | bit) = 0 THEN n ELSE 0 END) AS kept,
                          sum(CASE WHEN mask & coalesce(before, 0) = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
                          sum(CASE WHEN mask & coalesce(before, 0) <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
                          sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
                          sum(CASE WHEN mask & coalesce(before, 0) = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
                          sum(CASE WHEN mask & coalesce(before, 0) = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
                   FROM cells, steps GROUP BY part, filter_order, step, bit)
        SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
               CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
               CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
        FROM counts""",
    "op13_merkle_proofs": _merkle_sql(),
}
