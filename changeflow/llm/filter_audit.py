"""How filters share the documents that they remove: the potential of the removal game, steps, and losses.

Each document has a mask of the filters that it fails.  In the removal game a coalition of
filters is worth the documents that fail at least one of them.  The Hart-Mas-Colell potential of a coalition
is its worth plus the potentials of the coalitions with one filter less, over its size; a
filter's Shapley value is the potential of all filters minus that without it.  What a filter
does at its step of an order is a difference of two coalitions, so no order is ever run.

Documents are counted per part and mask on the map side; all that follows works on 32 numbers a part.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial, lcm

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import word_count

WORD = r"([^\x20\x09-\x0D]+)"
#: Fewest words, distinct words and capitals in percent, refused characters.
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, REFUSED = 50, 65, 5, r"[#$%&*|]"
FILTERS = "ABCDE"


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with _mask: bit k is set if the document fails filter k.

    A null text counts as empty.  The last filter fails a text that a row of a smaller id has, too: rows
    that share the smallest id of a text pass it, all of them, and so does a row without an id,
    which is no one's original either.  Texts are the same if their SHA-256 digests are.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(1))
    n = word_count(text)
    fails = [
        n < LEAST_WORDS,
        F.size(F.array_distinct(words)) * 100 < n * DISTINCT_PERCENT,
        F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.length(text) * CAPITAL_PERCENT,
        text.rlike(REFUSED),
    ]
    bits = sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))
    first = F.min(id_col).alias("_first")
    digest = F.sha2(text.cast("binary"), 256).alias("_digest")
    least = docs.select(F.col(id_col), digest).groupBy("_digest").agg(first)
    copy = F.when(F.coalesce(F.col(id_col) > F.col("_first"), F.lit(False)), 1 << len(fails)).otherwise(0)
    marked = docs.select("*", bits.alias("_bits"), digest).join(least, "_digest")
    return marked.select(*[F.col(c) for c in docs.columns], (F.col("_bits") + copy).alias("_mask"))


def audit(
    masks: DataFrame, parts: list[str], filters: str = FILTERS, mask: str = "_mask", losses: dict[str, str] | None = None
) -> DataFrame:
    """One row per part, order of the filters and step: filter, kept, removed, redundant, unique_fails, shapley, losses.

    `losses` maps output names to boolean columns of masks: documents of that kind removed at the
    step.  Counts are exact whole numbers; `shapley` is summed over all orders.  Few filters are meant: there
    are as many rows as orders and steps.  No documents give no rows.
    """
    count, all_ = len(filters), (1 << len(filters)) - 1
    kinds = {"_n": F.count("*"), **{f"_{k}": F.count(F.when(F.col(c), 1)) for k, c in (losses or {}).items()}}
    by_mask = masks.groupBy(*parts, F.col(mask).alias("_of")).agg(*[v.alias(k) for k, v in kinds.items()])
    row = F.collect_list(F.struct("_of", *kinds)).alias("_rows")  # one for each mask at most
    games = by_mask.groupBy(*parts).agg(row)

    def worth(kind: str) -> Column:
        """By coalition: documents of a kind that fail one of its filters."""
        return F.transform(
            F.sequence(F.lit(0), F.lit(all_)),
            lambda s: F.aggregate(
                "_rows",
                F.lit(0).cast("long"),
                lambda a, r: a + F.when(r["_of"].bitwiseAND(s) != 0, r[kind]).otherwise(0),
            ),
        )

    games = games.select(
        *parts,
        F.aggregate("_rows", F.lit(0).cast("long"), lambda a, r: a + r["_n"]).alias("_all"),
        *[worth(k).alias(f"_worth{k}") for k in kinds],
    ).withColumn("_potential", _potential("_worth_n", count))
    played = games.select("*", F.explode(_steps(filters)).alias("_s")).select("*", "_s.*")

    def value(kind: str, coalition: Column) -> Column:
        return F.get(F.col(f"_worth{kind}"), coalition)

    bit, before = F.col("_bit"), F.col("_before")
    after, without = before + bit, F.lit(all_) - bit
    removed = value("_n", after) - value("_n", before)
    share = (F.get("_potential", F.lit(all_)) - F.get("_potential", without)) * (factorial(count) // _scale(count))
    return played.select(
        *parts,
        "filter_order",
        "step",
        F.substring("filter_order", F.col("step"), F.lit(1)).alias("filter"),
        (F.col("_all") - value("_n", after)).alias("kept"),
        removed.alias("removed"),
        (value("_n", bit) - removed).alias("redundant"),
        (value("_n", F.lit(all_)) - value("_n", without)).alias("unique_fails"),
        *[(value(f"_{k}", after) - value(f"_{k}", before)).alias(k) for k in losses or {}],
        share.alias("shapley"),
    )


def _scale(count: int) -> int:
    """What makes all potentials whole: they are sums of whole numbers over coalition sizes."""
    return lcm(*range(1, count + 1))


def _potential(worth: str, count: int) -> Column:
    """Potentials by coalition, times `_scale`; a coalition's number is above those of its subsets."""

    def more(known: Column, s: Column) -> Column:
        below = F.transform(
            F.filter(F.array(*[F.lit(1 << k) for k in range(count)]), lambda b: s.bitwiseAND(b) != 0),
            lambda b: F.get(known, s - b),
        )
        total = F.aggregate(below, F.get(F.col(worth), s) * _scale(count), lambda a, x: a + x)
        size = F.bit_count(s)
        return F.concat(known, F.array(_whole(total, size)))

    return F.aggregate(
        F.sequence(F.lit(1), F.lit((1 << count) - 1)), F.array(F.lit(0).cast("long")), more
    )


def _whole(a: Column, b: Column) -> Column:
    """a over b, which divides it."""
    return F.call_function("div", a, b.cast("long"))


def _steps(filters: str) -> Column:
    """Every order and step, with the step's filter and the coalition of those before it as bits."""
    rows = []
    for order in permutations(range(len(filters))):
        before = 0
        for step, k in enumerate(order, start=1):
            name = "".join(filters[x] for x in order)
            rows.append((name, step, 1 << k, before))
            before |= 1 << k
    names = ("filter_order", "step", "_bit", "_before")
    return F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names)]) for row in rows])


def filter_interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of documents(doc_id, text, source) by source, with the labelled good and toxic documents lost.

    A document is good or toxic if any of its label rows says so; rows without an id have no
    label, and a null source is the part of the empty string.  Repeated rows count each; extra columns are ignored.
    """
    slim = docs.select("doc_id", "text", F.coalesce("source", F.lit("")).alias("part"))
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("_good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("_toxic"),
    )
    masked = failures(slim).drop("text").join(marks, "doc_id", "left")
    return audit(masked, ["part"], losses={"good_lost": "_good", "toxic_lost": "_toxic"})


def audit_sql() -> str:
    """The audit in SQL, document by document through every order."""
    orders = ", ".join(f"('{''.join(p)}')" for p in permutations(FILTERS))
    return rf"""
WITH d AS (
  SELECT doc_id, COALESCE(source, '') AS part, COALESCE(text, '') AS text,
         regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
l AS (
  SELECT doc_id, MAX(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, MAX(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
f AS (
  SELECT part, COALESCE(l.good, 0) AS good, COALESCE(l.toxic, 0) AS toxic,
    CASE WHEN len(words) < 50 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN d.doc_id > MIN(d.doc_id) OVER (PARTITION BY d.text) THEN 'E' ELSE '' END AS fails
  FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
c AS (SELECT part, fails, COUNT(*) AS n, SUM(good) AS good, SUM(toxic) AS toxic FROM f GROUP BY part, fails),
o AS (SELECT * FROM (VALUES {orders}) t(filter_order)),
s AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS filter, substr(filter_order, 1, step - 1) AS earlier
  FROM o, (SELECT UNNEST([1, 2, 3, 4, 5]) AS step)),
m AS (
  SELECT part, filter_order, step, filter, n, good, toxic, fails,
         contains(fails, filter) AS failing,
         length(translate(fails, earlier, '')) < length(fails) AS gone
  FROM c, s),
r AS (
  SELECT part, filter_order, step, filter,
    COALESCE(SUM(n) FILTER (NOT gone AND NOT failing), 0)::BIGINT AS kept,
    COALESCE(SUM(n) FILTER (NOT gone AND failing), 0)::BIGINT AS removed,
    COALESCE(SUM(n) FILTER (gone AND failing), 0)::BIGINT AS redundant,
    COALESCE(SUM(n) FILTER (fails = filter), 0)::BIGINT AS unique_fails,
    COALESCE(SUM(good) FILTER (NOT gone AND failing), 0)::BIGINT AS good_lost,
    COALESCE(SUM(toxic) FILTER (NOT gone AND failing), 0)::BIGINT AS toxic_lost
  FROM m GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (SUM(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley
FROM r
"""
