"""Run the checks as a few fused aggregates.

Row rules of a table are counted in one scan. The keys of all duplicate checks, and of all
references, become bitmap words where the rows are and share one shuffle; counts of keys are
taken when a family is asked for. All results are rows of one DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.operators.key_words import bit_of, distinct_in, word_of, words
from cartwright.quality import specs
from cartwright.sources.scratch import Scratch

RESULT = """check_id string, category string, table_name string, description string,
    passed boolean, failing_rows bigint, details string"""
ABOUT = ("check_id", "category", "table_name", "description")
CheckResults = DataFrame
#: So many orphaned words of 20 bytes are broadcast, more are joined by a shuffle.
FEW_WORDS = 200_000


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _outcome(failing: Column, details: Column | None = None) -> list[Column]:
    """The last columns of a check row."""
    count = F.coalesce(failing, F.lit(0)).cast("bigint")
    return [
        (count == 0).alias("passed"),
        count.alias("failing_rows"),
        (F.lit("") if details is None else details).alias("details"),
    ]


def _result(
    check_id: str, category: str, table: str, description: str, failing: Column
) -> list[Column]:
    """Columns of a check row."""
    return [
        F.lit(check_id).alias("check_id"),
        F.lit(category).alias("category"),
        F.lit(table).alias("table_name"),
        F.lit(description).alias("description"),
        *_outcome(failing),
    ]


def _number_of(table: DataFrame, column: str) -> tuple[Column, bool]:
    """A key as a whole number: itself, or a hash of its text."""
    key = F.col(column)
    if isinstance(table.schema[column].dataType, T.IntegralType):
        return key.cast("bigint"), False
    return F.when(key.isNotNull(), F.xxhash64(key.cast("string"))), True


def sql_type(data_type: T.DataType) -> str:
    """Type name as the schema checks write it."""
    names = {
        "int": "INTEGER",
        "string": "VARCHAR",
        "timestamp_ntz": "TIMESTAMP",
        "timestamp": "TIMESTAMP WITH TIME ZONE",
    }
    plain = data_type.simpleString()
    return names.get(plain, plain.upper())


class Checks:
    """Checks over tables found by ``table(name)``, with names such as ``gold.fact_orders``."""

    def __init__(
        self,
        spark: SparkSession,
        table: Callable[[str], DataFrame],
        id_type: str = "int",
        null_parent_passes: bool = True,
        parents: Callable[[str], DataFrame] | None = None,
    ):
        """``null_parent_passes`` keeps the rule of ``NOT IN``: one NULL among the parent's
        keys lets every child pass. Without it such children are still compared.
        ``parents`` finds the tables that references are looked up in, where they are others.
        """
        self.spark, self.table = spark, table
        self.parents = parents or table
        self.id_type = "INTEGER" if id_type == "int" else "BIGINT"
        self.null_parent_passes = null_parent_passes

    # one row at a time

    def row_checks(self, rules: list[specs.RowRule]) -> DataFrame:
        by_table: dict[str, list[int]] = {}
        for number, rule in enumerate(rules):
            by_table.setdefault(rule.table, []).append(number)
        counts = _union(
            [self._count_failing(name, rules, some) for name, some in by_table.items()]
        )
        checks = [(i, r.check_id, r.category, r.table, r.description) for i, r in enumerate(rules)]
        # One row per check.
        counted = self._check_rows(checks).join(F.broadcast(counts), "check_no")
        return counted.select(*ABOUT, *_outcome(F.col("n")))

    def _count_failing(self, name: str, rules: list[specs.RowRule], some: list[int]) -> DataFrame:
        """Failing rows per rule number, for the rules of one table, in one scan."""
        counts = ", ".join(
            f"named_struct('check_no', {i}, 'n', count_if({rules[i].fails}))" for i in some
        )
        return self.table(name).agg(F.expr(f"array({counts})").alias("c")).select(F.inline("c"))

    def _check_rows(self, checks: list[tuple[int, str, str, str, str]]) -> DataFrame:
        """Check numbers with what is reported about them; a few constant rows."""
        rows = ", ".join(
            f"({number}, '{check_id}', '{category}', '{name}', '{text}')"
            for number, check_id, category, name, text in checks
        )
        return self.spark.sql(
            f"SELECT * FROM VALUES {rows}"
            " AS t(check_no, check_id, category, table_name, description)"
        )

    def nulls(self) -> DataFrame:
        return self.row_checks([r for r in specs.row_rules() if r.category == "null"])

    def arithmetic(self) -> DataFrame:
        return self.row_checks([r for r in specs.row_rules() if r.category == "arithmetic"])

    def non_negative(self) -> DataFrame:
        return self.row_checks(
            [r for r in specs.row_rules() if r.check_id.startswith("arith_nonneg_")]
        )

    # metadata

    def schemas(self) -> DataFrame:
        """Listed columns exist with exactly the listed type; compares columns, reads no rows.

        What is listed is joined with what the stored tables have; the rest is what is wrong.
        """
        wanted = [
            (name, place, column, self.id_type if kind == "ID" else kind)
            for name, spec in specs.SCHEMAS.items()
            for place, (column, kind) in enumerate(spec)
        ]
        actual = [(n, f.name, sql_type(f.dataType)) for n in specs.SCHEMAS for f in self.table(n).schema]
        listed = self.spark.createDataFrame(wanted, "table_name string, place int, column string, wanted string")
        found = self.spark.createDataFrame(actual, "table_name string, column string, got string")
        # A row for each listed column.
        compared = listed.join(F.broadcast(found), ["table_name", "column"], "left")

        def all_of(what: str, rows: Column, text: Column) -> Column:
            picked = F.array_sort(F.collect_list(F.when(rows, F.struct("place", text.alias("text")))))
            texts = F.array_join(picked["text"], "', '")
            return F.when(F.size(picked) > 0, F.concat(F.lit(f"{what}: ['"), texts, F.lit("']")))

        differs = F.format_string("%s: expected %s, got %s", "column", "wanted", "got")
        missing = all_of("missing columns", F.col("got").isNull(), F.col("column"))
        mismatches = all_of("type mismatches", F.col("got") != F.col("wanted"), differs)
        judged = compared.groupBy("table_name").agg(F.concat_ws("; ", missing, mismatches).alias("details"))
        return judged.select(
            F.concat(F.lit("schema_"), "table_name").alias("check_id"),
            F.lit("schema").alias("category"),
            "table_name",
            F.lit("Schema matches expected definition").alias("description"),
            (F.col("details") == "").alias("passed"),
            F.lit(0).cast("bigint").alias("failing_rows"),
            "details",
        )

    # keys

    def duplicates(self) -> DataFrame:
        """Rows beyond the number of distinct non-NULL keys; NULL keys count as duplicates.

        The keys of all checks share one shuffle of bitmap words (``key_words``): whole numbers as
        such, which is exact, keys of any other type by a hash of their text. A hash can only hide
        that texts differ, so a check whose hashes are all different is done; for the others the
        texts of the words in question are compared.
        """
        checks, parts, texts = [], [], []
        for name, columns in specs.UNIQUE.items():
            table = self.table(name)
            keys = []
            for column in columns:
                about = (f"dup_{name}.{column}", "duplicate", name, f"{column} is unique")
                key, is_text = _number_of(table, column)
                if is_text:
                    texts.append((len(checks), name, column))
                keys.append(F.struct(F.lit(len(checks)).alias("check_no"), key.alias("key")))
                checks.append((len(checks), *about))
            parts.append(table.select(F.inline(F.array(*keys))))
        per_check = words(_union(parts), "check_no").groupBy("check_no").agg(
            F.sum("rows").alias("total"),
            F.sum(F.when(F.col("word").isNotNull(), F.col("rows"))).alias("present"),
            F.sum(distinct_in(F.col("bits"))).alias("different"),
        )
        # One row per check.
        counts = {r["check_no"]: r.asDict() for r in per_check.collect()}
        unsure = [t for t in texts if t[0] in counts and counts[t[0]]["different"] < (counts[t[0]]["present"] or 0)]
        for number, name, column in unsure:
            counts[number]["different"] = counts[number]["present"] - self._repeated_texts(name, column)
        rows = [(n, c["total"], c["different"]) for n, c in counts.items()]
        counted = self._check_rows(checks).join(
            F.broadcast(self.spark.createDataFrame(rows, "check_no int, _total bigint, _distinct bigint")), "check_no", "left"
        )
        extra = F.coalesce(F.col("_total") - F.col("_distinct"), F.lit(0))
        details = F.when(
            extra > 0, F.format_string("%d total, %d distinct", "_total", "_distinct")
        ).otherwise("")
        return counted.select(*ABOUT, *_outcome(extra, details))

    def _repeated_texts(self, name: str, column: str) -> int:
        """Rows beyond the different texts; only texts in words with fewer bits than rows are shuffled."""
        text = F.col(column).cast("string")
        keys = self.table(name).select(text.alias("text"), F.xxhash64(text).alias("key")).where("text IS NOT NULL")
        crowded = words(keys).where(F.col("rows") > distinct_in(F.col("bits"))).select("word")
        suspects = keys.withColumn("word", word_of(F.col("key"))).join(crowded, "word", "left_semi")
        each = suspects.groupBy("text").agg((F.count(F.lit(1)) - 1).alias("n"))
        return each.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def references(self) -> DataFrame:
        """Child rows whose key the parent lacks; NULL child keys are skipped.

        Keys of children and parents become bitmap words before anything is shuffled
        (``key_words``); a child's bits that its parent lacks are orphans. Only if there are any,
        the children are read again to count their rows. Keys that are not whole numbers
        are compared by an anti join on their text.
        """
        checks, parents, numbers, texts = [], {}, [], []
        for child, links in specs.REFERENCES.items():
            for column, parent_table, parent_column in links:
                target = f"{parent_table}.{parent_column}"
                number, parent = len(checks), parents.setdefault(target, len(parents))
                kinds = (self.table(child).schema[column], self.parents(parent_table).schema[parent_column])
                whole = all(isinstance(f.dataType, T.IntegralType) for f in kinds)
                (numbers if whole else texts).append((number, parent, child, column, parent_table, parent_column))
                about = (f"fk_{child}.{column}__{target}", "referential", child)
                checks.append((number, *about, f"{column} → {target}"))
        lost = [x for x in (self._lost_numbers(numbers), self._lost_texts(texts)) if x is not None]
        if not lost:
            lost = [self.spark.createDataFrame([], "check_no int, _lost bigint")]
        failing = F.coalesce("_lost", F.lit(0))
        # One row per check, and one per parent.
        result = self._check_rows(checks).join(F.broadcast(_union(lost)), "check_no", "left")
        if self.null_parent_passes:
            pairs = [(number, parent) for number, parent, *_ in numbers + texts]
            parent_of = self.spark.createDataFrame(pairs, "check_no int, parent_no int")
            nulls = _union(
                [
                    self.parents(table).where(F.col(column).isNull()).agg(F.count(F.lit(1)).alias("_nulls"))
                    .select(F.lit(number).alias("parent_no"), "_nulls")
                    for target, number in parents.items()
                    for table, column in [target.rsplit(".", 1)]
                ]
            )
            result = result.join(F.broadcast(parent_of), "check_no").join(
                F.broadcast(nulls), "parent_no", "left"
            )
            failing = F.when(F.col("_nulls") > 0, F.lit(0)).otherwise(failing)
        return result.select(*ABOUT, *_outcome(failing))

    def _children(self, links: list[tuple]) -> DataFrame:
        """(check_no, parent_no, key) of every child row and link; one scan a child."""
        by_child: dict[str, list[Column]] = {}
        for number, parent, child, column, *_ in links:
            key = F.col(column).cast("bigint").alias("key")
            by_child.setdefault(child, []).append(
                F.struct(F.lit(number).alias("check_no"), F.lit(parent).alias("parent_no"), key)
            )
        return _union([self.table(c).select(F.inline(F.array(*keys))) for c, keys in by_child.items()]).where("key IS NOT NULL")

    def orphan_words(self, links: list[tuple]) -> DataFrame:
        """(check_no, word, orphans): bits of child keys that the parent lacks."""
        of_parent = {parent: (table, column) for _, parent, _, _, table, column in links}
        keys = [
            self.parents(table).select(F.lit(parent).alias("parent_no"), F.col(column).cast("bigint").alias("key"))
            for parent, (table, column) in of_parent.items()
        ]
        held = words(_union(keys), "parent_no").select("parent_no", "word", F.col("bits").alias("_held"))
        used = words(self._children(links), "check_no", "parent_no")
        orphans = F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce("_held", F.lit(0))))
        return used.join(held, ["parent_no", "word"], "left").select("check_no", "word", orphans.alias("orphans")).where("orphans <> 0")

    def _lost_numbers(self, links: list[tuple]) -> DataFrame | None:
        if not links:
            return None
        orphans = Scratch(self.spark).stage(self.orphan_words(links), "orphans")
        found = {r["check_no"]: r["n"] for r in orphans.groupBy("check_no").agg(F.count(F.lit(1)).alias("n")).collect()}
        if not found:
            return None
        if sum(found.values()) <= FEW_WORDS:
            orphans = F.broadcast(orphans)
        rows = self._children([x for x in links if x[0] in found]).withColumn("word", word_of(F.col("key")))
        hit = bit_of(F.col("key")).bitwiseAND(F.col("orphans")) != 0
        return rows.join(orphans, ["check_no", "word"]).where(hit).groupBy("check_no").agg(F.count(F.lit(1)).alias("_lost"))

    def _lost_texts(self, links: list[tuple]) -> DataFrame | None:
        if not links:
            return None
        lost = []
        for number, _, child, column, parent_table, parent_column in links:
            # Counted per text first, so a text of many rows is one row of a task.
            texts = self.table(child).select(F.col(column).cast("string").alias("key")).where("key IS NOT NULL")
            each = texts.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
            known = self.parents(parent_table).select(F.col(parent_column).cast("string").alias("key"))
            missing = each.join(known, "key", "left_anti").agg(F.sum("n").alias("_lost"))
            lost.append(missing.select(F.lit(number).alias("check_no"), "_lost"))
        return _union(lost)

    def _unless_null_parent(self, lost: DataFrame, keys: DataFrame) -> DataFrame:
        """One row: ``lost.n``, or 0 when a NULL key lets everything pass."""
        if not self.null_parent_passes:
            return lost.select(F.col("n").alias("failing"))
        nulls = keys.where(F.col("_key").isNull()).agg(F.count(F.lit(1)).alias("n"))
        both = lost.select(F.lit(True).alias("_lost"), "n").unionByName(
            nulls.select(F.lit(False).alias("_lost"), "n")
        )
        failing = F.when(
            F.max(F.when(~F.col("_lost"), F.col("n"))) > 0, F.lit(0)
        ).otherwise(F.max(F.when(F.col("_lost"), F.col("n"))))
        return both.agg(failing.alias("failing"))

    # currency

    def currency(self) -> DataFrame:
        positive = [r for r in specs.row_rules() if r.category == "currency"]
        return _union(
            [self._currency_match(), self._currency_known(), self.row_checks(positive)]
        )

    def _currency_match(self) -> DataFrame:
        """Pairs of an order and its payment in different currencies, counted per currency."""

        def per_currency(name: str, prefix: str) -> DataFrame:
            counted = self.table(name).where("order_sk IS NOT NULL AND currency IS NOT NULL")
            return counted.groupBy("order_sk", F.col("currency").alias(f"{prefix}_currency")).agg(
                F.count(F.lit(1)).alias(f"{prefix}_rows")
            )

        orders = per_currency("gold.fact_orders", "o")
        payments = per_currency("gold.fact_payments", "p")
        failing = (
            orders.join(payments, "order_sk")
            .where("o_currency <> p_currency")
            .agg(F.sum(F.col("o_rows") * F.col("p_rows")).alias("failing"))
        )
        return failing.select(
            *_result(
                "currency_order_payment_match",
                "currency",
                "gold.fact_orders ↔ gold.fact_payments",
                "order currency equals payment currency",
                F.col("failing"),
            )
        )

    def _currency_known(self) -> DataFrame:
        """Currencies, not rows, without an exchange rate."""
        used = self.table("gold.fact_orders").where("currency IS NOT NULL")
        keys = self.table("silver.seed_exchange_rates").select(F.col("currency").alias("_key"))
        lost = (
            used.select(F.col("currency").alias("_key")).distinct().join(keys, "_key", "left_anti")
        )
        failing = self._unless_null_parent(lost.agg(F.count("_key").alias("n")), keys)
        return failing.select(
            *_result(
                "currency_known_rate",
                "currency",
                "gold.fact_orders",
                "every order currency has an exchange rate",
                F.col("failing"),
            )
        )

    def all(self) -> CheckResults:
        """Every check, one row each. Row rules of a table share one scan across families."""
        return _union(
            [
                self.row_checks(specs.row_rules()),
                self.schemas(),
                self.duplicates(),
                self.references(),
                self._currency_match(),
                self._currency_known(),
            ]
        )
