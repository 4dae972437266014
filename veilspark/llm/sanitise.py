"""Information-theoretic sanitisation of personal data, built-in functions only.

Patterns find the protected entities: mail addresses, IP addresses, card and
phone numbers.  Other words of its documents may give an entity away too.  How strongly is
estimated from the corpus: with ``p`` over documents, the information that a
term ``t`` gives about an entity ``e`` is ``log2(p(t, e) / (p(t) p(e)))``, and
its share of the entity's whole information ``-log2 p(e)`` is 1 for a term that
occurs nowhere else.  Terms above one threshold are removed from the entity's
documents, terms above a lower one are generalised.

A term is a run of letters, marks and digits.  It counts with an entity in every
document that holds both, wherever it stands, and needs two different texts in which
it does.  Document counts of terms and entities are over all documents, with partial
sums before every shuffle.  :func:`disclosing_terms` alone can be held to long words near a mention.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilspark.llm.common import saved, text_or_empty

WINDOW = 100       # characters on either side of a mention, where only words near one count
SUPPORT = 2        # different texts in which a term stands with an entity
REMOVE, GENERALISE = 0.9, 0.7  # shares of an entity's information

KINDS = ("email", "ip", "card", "phone")
TERM = "term"

# The patterns of the four kinds.  A run of characters that can only match from
# its start is entered there alone, and never given back, so a long run is read once.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20\-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9\-]+[0-9]",
}
WORD = r"\p{L}{4,}+"  # a term near a mention
TERMS = r"[\p{L}\p{M}\p{N}]++"  # a term of a whole text

SPANS = "array<struct<start:bigint,end:bigint,value:string>>"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Every second digit from the right, doubled, its own digits added: the sum is a multiple of 10."""
    back = F.reverse(digits)

    def part(i):
        d = F.substring(back, i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + part(i)) % 10 == 0


VALID = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: F.forall(F.split(m, "[.]"), lambda p: p.rlike("^0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])$")),
    "card": lambda m: F.when(F.length(_digits(m)).between(16, 19), _luhn(_digits(m))).otherwise(False),
    "phone": lambda m: F.length(_digits(m)).between(8, 15),
}

# what a text must hold at least; texts without it are not searched
LIKELY = {
    "email": lambda t: F.instr(t, "@") > 0,
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
    "card": lambda t: t.rlike(r"(?:[0-9][\x20\-]?){15}[0-9]"),
    "phone": lambda t: F.instr(t, "+") > 0,
}


def matches(text: Column, pattern: str, valid, likely: Column) -> Column:
    """Matches of ``pattern`` from left to right that are ``valid``, with their
    places in code points: the lengths of the texts between matches and of the
    matches before are added up."""
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.zip_with(between, found, lambda g, m: F.struct(F.length(g).cast("long").alias("gap"), m.alias("m")))
    none = F.array().cast(SPANS)

    def add(acc, x):
        start = acc["at"] + x["gap"]
        end = start + F.coalesce(F.length(x["m"]), F.lit(0))
        one = F.array(F.struct(start.alias("start"), end.alias("end"), x["m"].alias("value")))
        ok = x["m"].isNotNull() & valid(x["m"])
        return F.struct(end.alias("at"), F.when(ok, F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    zero = F.struct(F.lit(0).cast("long").alias("at"), none.alias("out"))
    return F.when(likely, F.aggregate(parts, zero, add, lambda a: a["out"])).otherwise(none)


def base_spans(docs: DataFrame) -> DataFrame:
    """``row, doc_id, email, ip, card, phone, body`` for every row of ``docs``: the
    spans of each kind, and the text where it has any span.  Written once: ``row`` names a row from then on."""
    t = F.col("body")
    d = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("body"))
    d = d.select("row", "doc_id", "body", *[matches(t, PATTERNS[k], VALID[k], LIKELY[k](t)).alias(k) for k in KINDS])
    some = sum((F.size(k) for k in KINDS), F.lit(0)) > 0
    return saved(d.withColumn("body", F.when(some, t)), "pii-base")


def _name(kind: str, value: Column) -> Column:
    """The entity that a mention names."""
    plain = {"email": F.lower, "ip": lambda v: v, "card": _digits, "phone": _digits}[kind]
    return F.concat(F.lit(kind + ":"), plain(value))


def _names() -> Column:
    """The distinct entities of a row."""
    def names(kind):
        return F.transform(kind, lambda s: _name(kind, s["value"]))

    return F.array_distinct(F.concat(*[names(k) for k in KINDS]))


def mentions(base: DataFrame) -> DataFrame:
    """``row, entity, text_key, near``: one row per mention; ``near`` is the text around it."""
    def entities(kind):
        return F.transform(kind, lambda s: F.struct(_name(kind, s["value"]).alias("entity"), s["start"].alias("start"), s["end"].alias("end")))

    lists = [entities(k) for k in KINDS]
    m = base.where(F.col("body").isNotNull()).select("row", "body", F.explode(F.concat(*lists)).alias("m"))
    start, end = F.col("m.start").cast("int"), F.col("m.end").cast("int")
    first = F.greatest(start - WINDOW, F.lit(0))
    # the word that the window's edge may have cut goes
    before = F.when(first > 0, F.regexp_replace(F.substring("body", first + 1, start - first), r"^\p{L}+", "")).otherwise(F.substring("body", F.lit(1), start))
    after = F.substring("body", end + 1, F.lit(WINDOW))
    after = F.when(F.length(after) == WINDOW, F.regexp_replace(after, r"\p{L}+$", "")).otherwise(after)
    return m.select("row", F.col("m.entity").alias("entity"), F.xxhash64("body").alias("text_key"), F.concat_ws(" ", before, after).alias("near"))


def _words(text: Column, pattern: str = WORD) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0)))


def _near_pairs(base: DataFrame, support: int) -> DataFrame:
    """``entity, term, n_te``: words near a mention, in how many rows."""
    near = mentions(base).select("row", "entity", F.col("text_key"), F.explode(_words(F.col("near"))).alias("term")).distinct()
    return (near.groupBy("entity", "term", "text_key").agg(F.count("*").alias("n"))
            .groupBy("entity", "term").agg(F.sum("n").alias("n_te"), F.count("*").alias("texts"))
            .where(F.col("texts") >= support).select("entity", "term", "n_te"))


def _whole_pairs(base: DataFrame, support: int) -> DataFrame:
    """``entity, term, n_te``: terms of whole texts, in how many rows with the entity.  A row has each
    of its terms and entities once, so rows are counted before the shuffle, by both: a frequent entity spreads over its terms."""
    rows = base.where(F.col("body").isNotNull()).select(
        _names().alias("names"), F.xxhash64("body").alias("text_key"), F.explode(_words(F.col("body"), TERMS)).alias("term"))
    pairs = rows.select(F.explode("names").alias("entity"), "term", "text_key").groupBy("entity", "term")
    if support > 2:
        counted = pairs.agg(F.count("*").alias("n_te"), F.count_distinct("text_key").alias("texts")).where(F.col("texts") >= support)
    else:
        counted = pairs.agg(F.count("*").alias("n_te"), F.min("text_key").alias("a"), F.max("text_key").alias("b"))
        counted = counted.where("a <> b") if support == 2 else counted
    return counted.select("entity", "term", "n_te")


def _entities(base: DataFrame) -> DataFrame:
    """``row, entity``: the distinct entities of every row."""
    return base.where(F.col("body").isNotNull()).select("row", F.explode(_names()).alias("entity"))


def disclosing_terms(docs: DataFrame, base: DataFrame, remove: float = REMOVE, generalise: float = GENERALISE, support: int = SUPPORT,
                     whole: bool = False) -> DataFrame:
    """``entity, term, share, remove``: the terms that disclose an entity; of the ``whole`` texts
    of its documents, or else the long words near its mentions."""
    pairs = saved(_whole_pairs(base, support) if whole else _near_pairs(base, support), "pii-pairs")
    n_e = _entities(base).groupBy("entity").agg(F.count("*").alias("n_e"))
    n_t = docs.select(F.explode(_words(text_or_empty(), TERMS if whole else WORD)).alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    total = docs.count()
    j = pairs.join(n_t, "term").join(n_e, "entity")
    given = F.log2(F.lit(float(max(total, 1))) * F.col("n_te") / (F.col("n_t") * F.col("n_e")))
    whole = F.log2(F.lit(float(max(total, 1))) / F.col("n_e"))
    share = F.when(whole > 0, given / whole).otherwise(0.0)
    return j.withColumn("share", share).where(F.col("share") >= generalise).select("entity", "term", "share", (F.col("share") >= remove).alias("remove"))


def find_spans(docs: DataFrame, remove: float = REMOVE, generalise: float = GENERALISE, support: int = SUPPORT) -> DataFrame:
    """``row, doc_id, email, ip, card, phone, terms, body``: one row per row of ``docs``.

    ``terms`` are the places of disclosing words, ``value`` being what to do
    (``remove`` or ``generalise``), outside the spans of the four kinds.  A
    null or empty text has no spans; ``body`` is null where there are none.
    Repeated rows and null ids give a row each and count each time.  Extra columns are ignored.
    """
    base = base_spans(docs)
    terms = disclosing_terms(docs, base, remove, generalise, support, whole=True)
    # one list per entity, so that a frequent entity meets its documents as one row
    lists = saved(terms.groupBy("entity").agg(F.collect_set(F.struct("term", "remove")).alias("found")), "pii-terms")
    per_row = (_entities(base).join(lists, "entity")
               .groupBy("row").agg(F.flatten(F.collect_list("found")).alias("found")))
    t = base.select("row", "body", *KINDS).join(per_row, "row")
    names = F.array_distinct(F.transform("found", lambda x: x["term"]))
    gone = F.array_distinct(F.transform(F.filter("found", lambda x: x["remove"]), lambda x: x["term"]))
    t = t.select("row", *KINDS, "body", names.alias("names"), gone.alias("gone"))
    places = matches(F.col("body"), TERMS, lambda m: F.array_contains(F.col("names"), F.lower(m)), F.lit(True))
    protected = F.concat(*[F.transform(k, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))) for k in KINDS])
    t = t.select("row", protected.alias("protected"), "gone", places.alias("places"))
    free = F.filter("places", lambda s: ~F.exists("protected", lambda p: (s["start"] < p["end"]) & (p["start"] < s["end"])))
    action = F.transform(free, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.when(
        F.array_contains("gone", F.lower(s["value"])), F.lit("remove")).otherwise(F.lit("generalise")).alias("value")))
    extra = saved(t.select("row", action.alias("terms")), "pii-term-spans")
    return (base.join(extra, "row", "left")
            .withColumn("terms", F.coalesce("terms", F.array().cast(SPANS))))


def _joined(columns: list[str]) -> Column:
    def texts(column, kind):
        return F.transform(column, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))

    return F.concat_ws(",", F.concat(*[texts(c, k) for c, k in zip(columns, [*KINDS, TERM])]))


def span_digests(spans: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` from :func:`find_spans`."""
    base, every = _joined(list(KINDS)), _joined([*KINDS, "terms"])
    return spans.select("doc_id", *[F.size(k).cast("long").alias("n_" + k) for k in KINDS],
                        F.sha2(base.cast("binary"), 256).alias("base_sha256"), every.alias("spans"))


MARKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "remove": "", "generalise": "[TERM]"}


def sanitise(docs: DataFrame, remove: float = REMOVE, generalise: float = GENERALISE, support: int = SUPPORT) -> DataFrame:
    """``doc_id, body``: texts with entities replaced by their kind, disclosing
    terms removed or generalised; null where nothing had to change.  Of overlapping spans the first counts."""
    s = find_spans(docs, remove, generalise, support)

    def marked(column, mark):
        return F.transform(column, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), mark(x["value"]).alias("mark")))

    lists = [marked(k, lambda v, m=MARKS[k]: F.lit(m)) for k in KINDS]
    lists.append(marked("terms", lambda v: F.when(v == "remove", F.lit(MARKS["remove"])).otherwise(F.lit(MARKS["generalise"]))))
    s = s.select("doc_id", "body", F.array_sort(F.concat(*lists)).alias("all"))

    def add(acc, x):
        cut = F.substring(F.col("body"), (acc["at"] + 1).cast("int"), (x["start"] - acc["at"]).cast("int"))
        return F.when(x["start"] < acc["at"], acc).otherwise(
            F.struct(x["end"].alias("at"), F.concat(acc["out"], cut, x["mark"]).alias("out")))

    zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    done = F.aggregate("all", zero, add, lambda a: F.concat(a["out"], F.substring(F.col("body"), (a["at"] + 1).cast("int"), F.length("body"))))
    return s.select("doc_id", F.when(F.col("body").isNotNull(), done).alias("body"))
