"""Row filters and column masks per reader: direct, as views, and by column tags.

These hold for readers who come through the library.  They are no substitute for
enforcement in a catalog.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

# Tag key, placeholder and group names of the access rules.
TAG = "classification"
PLACEHOLDER = "XXX"
BYPASS_GROUP = "platform-admins"
TEST_BYPASS_GROUPS = ("admins", "platform-admins")


def visible(value: Column, groups: Iterable[str], bypass: str = BYPASS_GROUP) -> Column:
    """The row filter: the value is a group of the reader, or the reader is in the bypass group.

    Three-valued as in SQL: a NULL value is visible to the bypass group only.
    Literal IN, so that it reaches the scan.
    """
    groups = list(groups)
    if bypass in groups:
        return F.lit(True)
    return value.isin(*groups) if groups else F.lit(False)


def row_filter(df: DataFrame, column: str, groups: Iterable[str], bypass: str = BYPASS_GROUP) -> DataFrame:
    """The rows a reader may see."""
    return df.where(visible(F.col(column), groups, bypass))


def member_rows(df: DataFrame, column: str, principals: DataFrame, principal: str) -> DataFrame:
    """Rows whose value is a group of a reader, by a semi join for long group lists."""
    groups = principals.where(F.col("principal") == principal).select(
        F.col("group_name").alias(column)
    )
    return df.join(groups.distinct(), column, "left_semi")


def masked(value: Column, data_type: DataType, groups: Iterable[str], group: str) -> Column:
    """The value for members of the group; else XXX for text and NULL of the same type otherwise."""
    if group in groups:
        return value
    cover = F.lit(PLACEHOLDER) if isinstance(data_type, StringType) else F.lit(None)
    return cover.cast(data_type)


def mask_text(df: DataFrame, column: str, groups: Iterable[str], group: str = "HR") -> DataFrame:
    """The column with XXX in place of its values, unless the reader is in the group."""
    if not isinstance(df.schema[column].dataType, StringType):
        raise TypeError(f"{column} is no text column")
    return _mask(df, {column: group}, groups)


def mask_number(df: DataFrame, column: str, groups: Iterable[str], group: str = "Finance") -> DataFrame:
    """The column with NULL in place of its values, unless the reader is in the group."""
    if isinstance(df.schema[column].dataType, StringType):
        raise TypeError(f"{column} is a text column")
    return _mask(df, {column: group}, groups)


def _mask(df: DataFrame, rules: Mapping[str, str], groups: Iterable[str]) -> DataFrame:
    groups = list(groups)
    columns = []
    for f in df.schema:
        column = F.col(f.name)
        if f.name in rules:
            column = masked(column, f.dataType, groups, rules[f.name])
        columns.append(column.alias(f.name, metadata=f.metadata))
    return df.select(*columns)


@dataclass(frozen=True)
class TableRules:
    """Direct rules of one table: the filter column, and the group that may read each masked column."""

    filter_column: str | None = None
    masks: Mapping[str, str] | None = None


def secured(df: DataFrame, rules: TableRules, groups: Iterable[str]) -> DataFrame:
    """Filter first, then masks, so that a masked column can still be the filter column."""
    groups = list(groups)
    rows = df if rules.filter_column is None else row_filter(df, rules.filter_column, groups)
    return _mask(rows, rules.masks or {}, groups)


def create_view(df: DataFrame, name: str, rules: TableRules, groups: Iterable[str]) -> DataFrame:
    """A temporary view that shows what the reader may see: filtered, masked or both."""
    view = secured(df, rules, groups)
    view.createOrReplaceTempView(name)
    return view


def view_filtered(df: DataFrame, name: str, column: str, groups: Iterable[str]) -> DataFrame:
    return create_view(df, name, TableRules(filter_column=column), groups)


def view_masked(df: DataFrame, name: str, masks: Mapping[str, str], groups: Iterable[str]) -> DataFrame:
    return create_view(df, name, TableRules(masks=masks), groups)


def view_secured(
    df: DataFrame, name: str, column: str, masks: Mapping[str, str], groups: Iterable[str]
) -> DataFrame:
    return create_view(df, name, TableRules(column, masks), groups)


def tag_columns(df: DataFrame, tags: Mapping[str, str]) -> DataFrame:
    """Attach classification tags; they are field metadata and survive parquet."""
    for name, tag in tags.items():
        df = df.withMetadata(name, {**df.schema[name].metadata, TAG: tag})
    return df


def column_tags(df: DataFrame) -> dict[str, str]:
    return {f.name: f.metadata[TAG] for f in df.schema if TAG in f.metadata}


@dataclass(frozen=True)
class TagPolicy:
    """A rule for every column with a tag: kind `filter`, or `mask` with the group that may read.

    `scope` is the table, or the prefix of tables that ends with a dot or is empty for all, that
    the rule holds for; `applies_to` are the groups that it is aimed at, all readers if None.
    """

    name: str
    tag: str
    kind: str
    group: str | None = None
    scope: str = ""
    applies_to: tuple[str, ...] | None = None

    def holds(self, table: str, groups: Iterable[str]) -> bool:
        inside = not self.scope or table == self.scope or table.startswith(self.scope.rstrip(".") + ".")
        return inside and (self.applies_to is None or bool(set(self.applies_to) & set(groups)))


# The three policies of the tag taxonomy.
STANDARD_POLICIES = (
    TagPolicy("own_state_only", "state", "filter"),
    TagPolicy("hide_personal", "pii", "mask", "HR"),
    TagPolicy("hide_pay", "financial", "mask", "Finance"),
)


def apply_tag_policies(
    df: DataFrame, policies: Sequence[TagPolicy], groups: Iterable[str], table: str = ""
) -> DataFrame:
    """The table under all policies that its name, its column tags and the reader's groups match.

    An untagged table is unchanged.  Two masks on one column raise.
    """
    groups = list(groups)
    rows, masks = df, {}
    for column, tag in column_tags(df).items():
        hits = [p for p in policies if p.tag == tag and p.holds(table, groups)]
        if len([p for p in hits if p.kind == "mask"]) > 1:
            raise ValueError(f"column {column} is masked by {[p.name for p in hits]}")
        for p in hits:
            if p.kind == "filter":
                rows = row_filter(rows, column, groups)
            else:
                masks[column] = p.group
    return _mask(rows, masks, groups)


def visible_rows(df: DataFrame, column: str, principals: DataFrame, bypass: str = BYPASS_GROUP) -> DataFrame:
    """How many rows each reader may see, and whether the reader proves anything about the filter.

    The table is counted per value in one pass; only these counts, and their sum as what a
    bypass group sees, meet the readers in one join and one aggregate.
    """
    group = F.col("group_name")
    every = F.col("every") == 1
    counts = (
        df.rollup(F.col(column).alias("value"))
        .agg(F.grouping_id().alias("every"), F.count("*").alias("rows"))
        .select(
            F.when(every, bypass).otherwise(F.col("value")).alias("group_name"),
            F.when(~every, F.col("rows")).alias("n"),
            F.when(every, F.col("rows")).alias("total"),
        )
    )
    return (
        principals.select("principal", "group_name")
        .distinct()
        .join(counts, "group_name", "left")
        .groupBy("principal")
        .agg(
            F.max(group == bypass).alias("bypasses"),
            F.max(group.isin(*TEST_BYPASS_GROUPS)).alias("excluded"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("member_rows"),
            F.coalesce(F.max("total"), F.lit(0)).alias("total"),
        )
        .select(
            "principal",
            F.when(F.col("bypasses"), F.col("total")).otherwise(F.col("member_rows")).alias("visible_rows"),
            (~F.col("excluded")).alias("proves"),
        )
    )


def verify_row_filter(
    df: DataFrame, column: str, principals: DataFrame, expected: DataFrame
) -> DataFrame:
    """Visible rows per reader against an expected maximum (principal, expected_rows).

    A reader in a bypass group proves nothing about the filter and is marked so.
    """
    excess = F.col("proves") & (F.col("visible_rows") > F.col("expected_rows"))
    return visible_rows(df, column, principals).join(expected, "principal", "left").select(
        "principal",
        "visible_rows",
        "expected_rows",
        "proves",
        F.coalesce(excess, F.lit(False)).alias("excess"),
    )


def verify_session_filter(view: DataFrame, groups: Iterable[str], expected_rows: int) -> DataFrame:
    """The row count of one reader's view against its expected maximum, as one row."""
    proves = not set(groups) & set(TEST_BYPASS_GROUPS)
    n = F.count("*")
    return view.agg(
        n.alias("visible_rows"),
        F.lit(expected_rows).cast("bigint").alias("expected_rows"),
        F.lit(proves).alias("proves"),
        (F.lit(proves) & (n > expected_rows)).alias("excess"),
    )


def verify_column_mask(view: DataFrame, column: str, placeholder: str | None = PLACEHOLDER) -> DataFrame:
    """Values of a masked column that are neither NULL nor the placeholder, over the whole column."""
    real = F.col(column).isNotNull()
    if placeholder is not None:
        real = real & (F.col(column) != placeholder)
    return view.agg(F.count("*").alias("rows"), F.count(F.when(real, 1)).alias("unmasked"))


def bypass_members(principals: DataFrame) -> DataFrame:
    """Readers for whom a filter test proves nothing, with the groups that make it so."""
    return (
        principals.where(F.col("group_name").isin(*TEST_BYPASS_GROUPS))
        .groupBy("principal")
        .agg(F.array_sort(F.collect_set("group_name")).alias("bypass_groups"))
    )


def is_test_reader(groups: Iterable[str]) -> bool:
    """True if a reader with these groups can validly test a row filter."""
    return not set(groups) & set(TEST_BYPASS_GROUPS)


def policy_coverage(
    tables: Mapping[str, DataFrame],
    policies: Sequence[TagPolicy],
    direct: Mapping[str, TableRules] | None = None,
) -> DataFrame:
    """Which mechanism covers which column, how many values that is, and where two overlap.

    Mechanisms come from the schemas; the value counts are one aggregate per table.
    """
    spark = next(iter(tables.values())).sparkSession
    direct = direct or {}
    found, counts = [], []
    for name, df in tables.items():
        for column, tag in column_tags(df).items():
            hits = [p for p in policies if p.tag == tag]
            found += [(name, column, tag, "tag policy", p.name) for p in hits]
            if not hits:
                found.append((name, column, tag, "none", None))
        rules = direct.get(name, TableRules())
        if rules.filter_column is not None:
            found.append((name, rules.filter_column, None, "table rule", "row filter"))
        found += [(name, c, None, "table rule", "column mask") for c in rules.masks or {}]
        covered = sorted({f[1] for f in found if f[0] == name})
        if covered:
            tallies = df.agg(*[F.count(c).alias(c) for c in covered])
            pairs = F.array(
                *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("covered_values")) for c in covered]
            )
            counts.append(tallies.select(F.lit(name).alias("table_name"), F.inline(pairs)))
    schema = "table_name string, column_name string, tag string, mechanism string, rule string"
    mechanisms = spark.createDataFrame(found, schema)
    if not counts:
        return mechanisms.withColumn("covered_values", F.lit(0).cast("bigint")).withColumn("overlap", F.lit(False))
    values = counts[0]
    for more in counts[1:]:
        values = values.unionByName(more)
    overlapping = mechanisms.groupBy("table_name", "column_name").agg(
        (F.count(F.when(F.col("mechanism") != "none", 1)) > 1).alias("overlap")
    )
    on = ["table_name", "column_name"]
    return mechanisms.join(values, on).join(overlapping, on)


def policy_audit_trail(audit_log: DataFrame, service: str, actions: Sequence[str]) -> DataFrame:
    """Policy events of one service, newest first; nested fields are read, not whole structs."""
    return (
        audit_log.where((F.col("service_name") == service) & F.col("action_name").isin(*actions))
        .select(
            "event_time",
            "action_name",
            F.col("user_identity.email").alias("actor"),
            F.col("request_params")["name"].alias("policy_name"),
            F.col("response.status_code").alias("status_code"),
        )
        .orderBy(F.col("event_time").desc())
    )
