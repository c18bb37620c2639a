"""Mixing sources to target weights by pivotal dependent rounding.

Each source gets a target in words; its documents all get the same expected number of copies,
target / size.  Whole copies are taken outright.  The fractional part is rounded by the
pivotal method: two documents with fractional probabilities meet, and words move at random
from one to the other until one of them is taken or left for certain; the other goes on with
what it has.  Expectations stay as they were and so does the sum of words, so that a source
misses its target by at most half a document: the last one, which meets none, goes to the nearer side.

Documents meet in small buckets.  Each bucket is one aggregate over its documents and leaves
at most one undecided document, and these are the documents of the next, smaller level: a
reduction tree of depth log(documents) / log(fan-in).  Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import numbered, stored, word_count

WEIGHTS = (1.0, 2.0, 3.0)
MOST_COPIES = 3
#: Documents that meet in one bucket, on average.
FAN_IN = 64
SEED = 20


def targets(sized: DataFrame, weights: tuple = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, documents, target) from sized(source, size).

    Sources in code point order, null last, get the weights in turn and share the sum of all
    sizes by them.  A target above `most` times its source's size stops there, and the excess is
    shared out again by weight among the others until none is above.
    """
    sums = stored(
        sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents")), "sources"
    )
    place = (F.col("_number") % len(weights) + 1).cast("int")
    weighed = stored(
        numbered(sums, F.col("source").asc_nulls_last(), name="ranged").select(
            "source", "source_size", "documents", F.element_at(F.array(*map(F.lit, weights)), place).alias("_weight")
        ),
        "weighed",
    )
    # Words per weight grow while sources stop at their limit; what they leave goes to the others.
    limit = F.col("source_size") * most
    level = 0.0
    while True:
        stopped = limit <= F.lit(level) * F.col("_weight")
        total, fixed, weight_left = weighed.agg(
            F.sum("source_size"), F.sum(F.when(stopped, limit)), F.sum(F.when(~stopped, F.col("_weight")))
        ).first()
        if not total or not weight_left:
            break
        raised = (total - (fixed or 0)) / weight_left
        if raised <= level:
            break
        level = raised
    target = F.least(limit.cast("double"), F.lit(level) * F.col("_weight"))
    return weighed.select("source", "source_size", "documents", target.alias("target"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple = WEIGHTS,
    most: int = MOST_COPIES,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) for every row of docs.

    size is the number of words.  Repeated rows are decided one by one; documents without
    words take no part in the rounding and get no copies.  A null source is a source of its
    own.  The draws come from ids and sizes, so reruns agree.  An empty table gives no rows.
    """
    sized = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            word_count(F.col(text_col).cast("string")).alias("size"),
        ),
        "sizes",
    )
    sources = stored(targets(sized, weights, most), "targets")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    share = F.least(share, F.lit(float(most)))
    joined = sized.join(sources, sized["source"].eqNullSafe(sources["source"])).select(
        "doc_id",
        sized["source"],
        "size",
        "source_size",
        "target",
        F.floor(share).alias("whole"),
        (share - F.floor(share)).alias("p"),
        "documents",
    )
    open_ = (F.col("size") > 0) & (F.col("p") > 0)
    settled = joined.where(~open_).withColumn("extra", F.lit(0))
    fields = ["doc_id", "source", "size", "source_size", "target", "whole"]
    results = [settled.select(*fields, (F.when(F.col("size") > 0, F.col("whole")).otherwise(0)).alias("copies"))]

    most_documents = sources.agg(F.max("documents")).first()[0] or 0
    pending = joined.where(open_)
    level = 0
    while True:
        buckets = F.greatest(F.lit(1), F.ceil(F.col("documents") / FAN_IN ** (level + 1)))
        place = F.pmod(F.xxhash64("doc_id", F.lit(level)), buckets)
        item = F.struct(F.xxhash64("doc_id", F.lit(SEED)).alias("draw"), *fields[:1], *fields[2:], "p", "documents")
        reduced = stored(
            pending.groupBy("source", place.alias("_bucket"))
            .agg(F.sort_array(F.collect_list(item)).alias("items"))
            .select("source", _pivotal("items", level).alias("r")),
            f"level{level}",
        )
        done = reduced.select("source", F.explode("r.done").alias("d")).select("source", "d.*")
        results.append(_copies(done, fields))
        rest = reduced.where("r.now is not null").select("source", "r.now.*")
        if most_documents <= FAN_IN ** (level + 1):  # one bucket per source
            results.append(_copies(_last(rest), fields))
            break
        pending = rest
        level += 1
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def _copies(decided: DataFrame, fields: list[str]) -> DataFrame:
    return decided.select(*fields, (F.col("whole") + F.col("p").cast("long")).alias("copies"))


def _uniform(*seeds: Column) -> Column:
    """A number from 0 to below 1 that the seeds give."""
    return F.pmod(F.xxhash64(*seeds), F.lit(1 << 52)) / F.lit(float(1 << 52))


def _pivotal(items: str, level: int) -> Column:
    """(done, now) of a list of items: those with p 0 or 1, and the one that may stay undecided."""

    def with_p(x: Column, p: Column) -> Column:
        return x.withField("p", p)

    def meet(state: Column, x: Column) -> Column:
        """One of the two is decided; the other, or nothing, goes on."""
        y = state["now"]
        words_x, words_y = x["size"] * x["p"], y["size"] * y["p"]
        gain_x = F.least(x["size"] - words_x, words_y)  # words that can go from y to x
        gain_y = F.least(y["size"] - words_y, words_x)
        to_x = _uniform(x["draw"], y["draw"], F.lit(level)) * (gain_x + gain_y) < gain_y
        x_full = to_x & (x["size"] - words_x <= words_y)
        y_empty = to_x & (x["size"] - words_x >= words_y)
        y_full = ~to_x & (y["size"] - words_y <= words_x)
        x_empty = ~to_x & (y["size"] - words_y >= words_x)
        moved = F.when(to_x, gain_x).otherwise(-gain_y)
        new_x = with_p(x, F.when(x_full, 1.0).when(x_empty, 0.0).otherwise((words_x + moved) / x["size"]))
        new_y = with_p(y, F.when(y_full, 1.0).when(y_empty, 0.0).otherwise((words_y - moved) / y["size"]))
        decided_x, decided_y = x_full | x_empty, y_full | y_empty
        return F.struct(
            F.concat(
                state["done"],
                F.when(decided_x & decided_y, F.array(new_x, new_y))
                .when(decided_x, F.array(new_x))
                .otherwise(F.array(new_y)),
            ).alias("done"),
            F.when(decided_x & decided_y, F.lit(None)).when(decided_x, new_y).otherwise(new_x).alias("now"),
        )

    column = F.col(items)
    nothing = F.filter(column, lambda x: F.lit(False))
    return F.aggregate(
        column,
        F.struct(nothing.alias("done"), F.get(nothing, 0).alias("now")),
        lambda state, x: F.when(
            state["now"].isNull(), F.struct(state["done"].alias("done"), x.alias("now"))
        ).otherwise(meet(state, x)),
    )


def _last(rest: DataFrame) -> DataFrame:
    """The one undecided document of a source goes where the fewer words are missed."""
    return rest.withColumn("p", F.when(F.col("p") >= 0.5, 1.0).otherwise(0.0))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of docs, each as often as the mix takes it; no other columns, which may have any names.

    Rows that repeat an id are matched with their decisions in order of source and size, null
    sources first.  Null and wordless texts are never taken; an empty table gives no rows.
    """
    decided = mix(docs, id_col, text_col, source_col)
    listed = decided.groupBy(F.col("doc_id").alias("_id")).agg(
        F.sort_array(F.collect_list(F.struct("source", "size", "copies"))).alias("_decisions")
    )
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"))
    ident, source, text = (F.col("_row").getField(c) for c in (id_col, source_col, text_col))
    order = Window.partitionBy(ident).orderBy(source.cast("string"), word_count(text.cast("string")))
    placed = whole.withColumn("_place", F.row_number().over(order))
    return (
        placed.join(listed, ident.eqNullSafe(F.col("_id")))
        .withColumn("_copies", F.element_at("_decisions", F.col("_place"))["copies"])
        .withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("_copies").cast("int"))))
        .select("_row.*")
    )
