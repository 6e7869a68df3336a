"""Data-quality operators (DQ)."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from tradewind import schemas
from tradewind.operators import aggregates, quality, suites
from tradewind.operators.joins import orphans
from tradewind.plans.batch_load import reconcile_load
from tradewind.plans.tested_models import run_tests
from tradewind.registry.contract import rendered_sql
from tradewind.registry.register import Register
from tradewind.registry.relations import FOREIGN_KEY_SQL, all_orphans
from tradewind.session import fresh_folder
from tradewind.sources import publish
from tradewind.sources.sinks import align
from tradewind.sources.star_tables import RAW, warehouse

REGISTER = Register()
query = REGISTER.query
C = F.col


def checked_table(spark, folder, name):
    """A raw table in the shape its suite expects."""
    schema = schemas.BATCH_TABLES.get(name) or schemas.landed(name)
    return align(RAW[name](spark, folder), schema, strict=False)


def literal(value) -> str:
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S}'"
    return f"'{value}'" if isinstance(value, str) else repr(value)


def checked_sql(name: str) -> str:
    """The same shape in SQL: suite columns only, times parsed where they are text."""
    schema = schemas.BATCH_TABLES.get(name) or schemas.landed(name)
    times = {"order_date", "shipped_date", "delivered_date"} | ({"created_at"} if name == "orders_history" else set())
    columns = ", ".join(
        f"TRY_CAST({column} AS TIMESTAMP) AS {column}" if column in times else column for column in schema.names)
    return f"SELECT {columns} FROM raw_{name}"


def check_sql(table: str, columns: list[str], suite: str, position: int, check: quality.Check,
              parents: dict[str, str]) -> str:
    """One check as a query of one row, straight from its definition."""
    name, whole = check.column, False
    if check.kind in ("column_exists", "column_count", "row_count"):
        whole = True
        if check.kind == "column_exists":
            elements, unexpected = f"{int(name in columns)}", f"{int(name not in columns)}"
        elif check.kind == "column_count":
            elements, unexpected = f"{len(columns)}", f"{int(len(columns) != check.low)}"
        else:
            elements = f"(SELECT count(*) FROM {table})"
            unexpected = f"CASE WHEN {elements} BETWEEN {check.low} AND {check.high} THEN 0 ELSE 1 END"
    elif check.kind == "not_null":
        elements = f"(SELECT count(*) FROM {table})"
        unexpected = f"(SELECT count(*) FROM {table} WHERE {name} IS NULL)"
    else:
        elements = f"(SELECT count({name}) FROM {table})"
        if check.kind == "unique":
            unexpected = (f"(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {table} "
                          f"WHERE {name} IS NOT NULL GROUP BY {name} HAVING count(*) > 1))")
        else:
            if check.kind == "in_set":
                condition = f"{name} IN ({', '.join(map(literal, check.values))})"
            elif check.kind == "matches":
                condition = f"regexp_matches({name}, '{check.pattern}')"
            elif check.kind == "references":
                condition = f"{name} IN (SELECT {check.values[1]} FROM {parents[check.values[0]]})"
            else:
                bounds = [f"{name} >= {literal(check.low)}"] if check.low is not None else []
                bounds += [f"{name} <= {literal(check.high)}"] if check.high is not None else []
                condition = " AND ".join(bounds)
            unexpected = f"(SELECT count(*) FROM {table} WHERE {name} IS NOT NULL AND NOT ({condition}))"
    judged = "1" if whole else "e"
    return (
        f"SELECT '{suite}' AS suite, {position} AS position, '{check.kind}' AS \"check\", '{name}' AS \"column\", "
        f"e AS element_count, u AS unexpected_count, "
        f"CASE WHEN {judged} > 0 THEN u / {judged} ELSE CAST(u AS DOUBLE) END AS unexpected_ratio, "
        f"CAST({check.mostly} AS DOUBLE) AS mostly, "
        f"CASE WHEN {judged} > 0 THEN ({judged} - u) / {judged} >= {check.mostly} ELSE u = 0 END AS success "
        f"FROM (SELECT CAST({elements} AS BIGINT) AS e, CAST({unexpected} AS BIGINT) AS u)"
    )


def suite_sql(table: str, columns: list[str], suite: str, checks, parents=None) -> str:
    return " UNION ALL ".join(
        check_sql(table, columns, suite, position, check, parents or {}) for position, check in enumerate(checks))


def evaluated(name: str, checks):
    def run(spark, folder):
        parents = {"customers": RAW["customers"](spark, folder)}
        return quality.evaluate(checked_table(spark, folder, name), name, checks, parents)

    return run


def register_checks(query_name: str, table: str, checks) -> None:
    schema = schemas.BATCH_TABLES.get(table) or schemas.landed(table)
    text = suite_sql("checked", schema.names, table, checks, {"customers": "raw_customers"})
    REGISTER.add(query_name, evaluated(table, checks), text, {"checked": checked_sql(table)})


# One query per kind of check, on the table where it can fail ...
register_checks("dq01_column_exists", "customers", [quality.column_exists("email"), quality.column_exists("fax")])
register_checks("dq02_column_count", "clickstream", [quality.column_count(18), quality.column_count(17)])
register_checks("dq03_not_null", "clickstream", [
    quality.not_null("event_id"), quality.not_null("user_id"), quality.not_null("user_id", 0.5),
    quality.not_null("category", 0.8)])
register_checks("dq04_unique", "orders_history", [quality.unique("order_id"), quality.unique("customer_id")])
register_checks("dq05_matches_regex", "customers", [
    quality.matches("email", suites.EMAIL_PATTERN), quality.matches("customer_id", r"^[0-9]+$"),
    quality.matches("phone", r"^\+[0-9]{1,2}-[0-9]+$", 0.9)])
register_checks("dq06_in_set", "orders_stream", [
    quality.in_set("order_status", schemas.ORDER_STATUSES), quality.in_set("shipping_country", ["US"], 0.4),
    quality.in_set("payment_method", schemas.PAYMENT_METHODS)])
register_checks("dq07_between", "inventory_updates", [
    quality.between("quantity_after", 0), quality.between("quantity_change", -50, 49),
    quality.between("quantity_before", high=30)])
register_checks("dq08_plausible_times", "orders_history", [
    quality.between("order_date", datetime(1996, 1, 1), datetime(2000, 12, 31, 23, 59, 59)),
    quality.between("created_at", datetime(1990, 1, 1), datetime(2010, 1, 1)),
    *suites._plausible("order_date")])
register_checks("dq09_row_count", "clickstream", [quality.row_count(1, 50_000_000), quality.row_count(1, 10)])
register_checks("dq10_known_customer", "orders_stream", [
    quality.references("customer_id", "customers", "customer_id", 0.99),
    quality.references("customer_id", "customers", "customer_id", 0.9)])
register_checks("dq11_mostly_thresholds", "orders_stream", [
    quality.matches("event_timestamp", r"^\d{4}-", mostly) for mostly in (1.0, 0.999, 0.99, 0.98)])

# ... and one per suite.
for _number, _name in enumerate(suites.SUITES, start=13):
    register_checks(f"dq{_number}_{_name}_suite", _name, suites.SUITES[_name]())

VERDICTS = {f"checked_{name}": checked_sql(name) for name in suites.SUITES}
VERDICTS |= {f"result_{name}": suite_sql(
    f"checked_{name}", (schemas.BATCH_TABLES.get(name) or schemas.landed(name)).names, name,
    suites.SUITES[name](), {"customers": "raw_customers"}) for name in suites.SUITES}


@query("dq12_gate", " UNION ALL ".join(
    f"SELECT suite, count(*) AS checks, count(*) FILTER (NOT success) AS failed, bool_and(success) AS success, "
    f"bool_and(success) AS loaded FROM result_{name} GROUP BY suite" for name in suites.SUITES), VERDICTS)
def _(spark, folder):
    """Every suite's verdict, and whether its gate let the load through."""
    result = None
    for name, suite in suites.SUITES.items():
        path = fresh_folder(spark, f"results-{name}")
        evaluated(name, suite())(spark, folder).write.parquet(path)
        results = spark.read.parquet(path)
        try:
            quality.require(results, name)
            loaded = True
        except quality.QualityError:
            loaded = False
        part = quality.verdict(results).withColumn("loaded", F.lit(loaded))
        result = part if result is None else result.unionByName(part)
    return result


# Two dates of every suite's table: one without repeated keys and missing values, one as it comes, with events
# that lost their id. The gate judges structure, missing values and keys.
GATED = {name: [check for check in suite() if check.kind in ("column_exists", "column_count", "not_null", "unique")]
         for name, suite in suites.SUITES.items()}
CLEAN_DAY, SPOILED_DAY = date(2001, 7, 1), date(2001, 7, 2)


def columns_of(name: str, kind: str) -> list[str]:
    return [check.column for check in GATED[name] if check.kind == kind]


def clean_rows(rows: DataFrame, name: str) -> DataFrame:
    kept = rows.dropna(subset=columns_of(name, "not_null"))
    for column in columns_of(name, "unique"):
        single = rows.groupBy(column).count().where("count = 1").select(column)
        kept = kept.join(single, column, "left_semi")
    return kept.select(*rows.columns)


def spoiled_rows(rows: DataFrame) -> DataFrame:
    if "event_id" not in rows.columns:
        return rows
    return rows.withColumn("event_id", F.when(C("kafka_offset") % 100 != 7, C("event_id")))


def gated_sql(name: str) -> dict[str, str]:
    schema = schemas.BATCH_TABLES.get(name) or schemas.landed(name)
    whole = " AND ".join(f"{column} IS NOT NULL" for column in columns_of(name, "not_null"))
    single = "".join(f" AND {column} IN (SELECT {column} FROM checked_{name} GROUP BY {column} HAVING count(*) = 1)"
                     for column in columns_of(name, "unique"))
    lost = " REPLACE (CASE WHEN kafka_offset % 100 <> 7 THEN event_id END AS event_id)" if "event_id" in schema.names else ""
    tables = {f"checked_{name}": checked_sql(name), f"clean_{name}": f"SELECT * FROM checked_{name} WHERE {whole}{single}",
              f"spoiled_{name}": f"SELECT *{lost} FROM checked_{name}"}
    return tables | {f"gate_{day}_{name}": suite_sql(f"{day}_{name}", schema.names, name, GATED[name]) for day in ("clean", "spoiled")}


GATES = {}
for _name in suites.SUITES:
    GATES |= gated_sql(_name)


@query("dq12_staged_loads", " UNION ALL ".join(f"""
    SELECT '{name}' AS suite, '{day}' AS load_day, failed, CASE WHEN failed = 0 THEN n ELSE 0 END AS arrived,
           CASE WHEN failed = 0 THEN 0 ELSE n END AS still_staged
    FROM (SELECT (SELECT count(*) FROM {kind}_{name}) AS n,
                 (SELECT count(*) FILTER (NOT success) FROM gate_{kind}_{name}) AS failed)"""
    for name in suites.SUITES for kind, day in (("clean", CLEAN_DAY), ("spoiled", SPOILED_DAY))), GATES)
def _(spark, folder):
    """What arrives in the tables when a clean and a spoiled date are staged, judged and published."""
    result = None
    for name in suites.SUITES:
        where = publish.Staging(*[fresh_folder(spark, f"dq12-{name}-{part}") for part in ("staged", "table", "results")])
        rows, failed = checked_table(spark, folder, name), {}
        for day, load in ((CLEAN_DAY, clean_rows(rows, name)), (SPOILED_DAY, spoiled_rows(rows))):
            publish.stage(load, where, "load_day", f"{day}")
            try:
                publish.publish(spark, name, where, "load_day", [f"{day}"], GATED[name])
                publish.clear(spark, where, "load_day", [f"{day}"])
            except quality.QualityError as error:
                failed[f"{day}"] = len(error.failures)
        days = spark.createDataFrame([(name, f"{day}", failed.get(f"{day}", 0)) for day in (CLEAN_DAY, SPOILED_DAY)],
                                     "suite string, load_day string, failed bigint")
        for label, path in (("arrived", where.table), ("still_staged", where.staged)):
            try:
                stored = spark.read.schema(rows.schema.add("load_day", "string")).parquet(path)
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":  # no load was let through
                    raise
                stored = spark.createDataFrame([], rows.schema.add("load_day", "string"))
            counts = stored.groupBy(C("load_day").cast("string").alias("load_day")).agg(F.count("*").alias(label))
            days = days.join(counts, "load_day", "left").na.fill(0, [label])
        result = days if result is None else result.unionByName(days)
    return result.select("suite", "load_day", "failed", "arrived", "still_staged")


# Column tests of the models, by kind of test.
def model_tests(kind: str):
    return {model: [check for check in suites.model_checks(model) if check.kind == kind]
            for model in suites.MODEL_TESTS}


def evaluate_models(kind: str):
    def run(spark, folder):
        """Results of one kind of test; what only other tests need is not computed."""
        checks = model_tests(kind)
        return run_tests(spark, warehouse(spark, folder), fresh_folder(spark, f"tests-{kind}"), checks.__getitem__)

    return run


def models_sql(kind: str) -> str:
    return " UNION ALL ".join(
        suite_sql(model, [check.column for check in checks], model, checks)
        for model, checks in model_tests(kind).items() if checks)


REGISTER.add("dq18_model_not_null", evaluate_models("not_null"), models_sql("not_null"))
REGISTER.add("dq19_model_unique", evaluate_models("unique"), models_sql("unique"))
REGISTER.add("dq20_model_accepted_values", evaluate_models("in_set"), models_sql("in_set"))

FRESH_AS_OF = datetime(2001, 7, 3, 12)


def freshness_sql() -> str:
    parts = []
    for name, (column, warn, error) in suites.FRESHNESS_LIMITS.items():
        parts.append(
            f"SELECT '{name}' AS source_name, newest_row, age_seconds, CASE WHEN newest_row IS NULL "
            f"OR age_seconds > {error * 3600} THEN 'error' WHEN age_seconds > {warn * 3600} THEN 'warn' "
            f"ELSE 'pass' END AS status FROM (SELECT max({column}) AS newest_row, "
            f"date_diff('second', max({column}), {literal(FRESH_AS_OF)}) AS age_seconds FROM raw_{name})")
    return f"SELECT source_name, {rendered_sql('newest_row')}, age_seconds, status FROM ({' UNION ALL '.join(parts)})"


@query("dq21_source_freshness", freshness_sql())
def _(spark, folder):
    result = None
    for name, (column, warn, error) in suites.FRESHNESS_LIMITS.items():
        part = quality.freshness(RAW[name](spark, folder), name, column, warn, error, FRESH_AS_OF)
        result = part if result is None else result.unionByName(part)
    return result


@query("dq22_row_reconciliation", " UNION ALL ".join(f"""
    SELECT '{name}' AS table_name, s AS source_count, t AS target_count, abs(s - t) / s AS difference_ratio,
           abs(s - t) / s <= 0.01 AS within_tolerance
    FROM (SELECT (SELECT count(*) FROM raw_{name}) AS s,
                 (SELECT count(*) FROM raw_{name} WHERE _ingested_at <> TIMESTAMP '2001-07-02') AS t)"""
    for name in schemas.BATCH_TABLES))
def _(spark, folder):
    """All loads against the rows without the second load: too few, except of order items."""
    tables = {name: RAW[name](spark, folder) for name in schemas.BATCH_TABLES}
    first = {name: rows.where(C("_ingested_at") != F.lit("2001-07-02").cast("timestamp"))
             for name, rows in tables.items()}
    return reconcile_load(tables, first)


@query("dq23_check_constraints", " UNION ALL ".join(
    suite_sql(f"checked_{name}", schemas.BATCH_TABLES[name].names, name, checks)
    for name, checks in suites.CONSTRAINTS.items()),
    {f"checked_{name}": checked_sql(name) for name in suites.CONSTRAINTS})
def _(spark, folder):
    result = None
    for name, checks in suites.CONSTRAINTS.items():
        part = evaluated(name, checks)(spark, folder)
        result = part if result is None else result.unionByName(part)
    return result


REGISTER.add(
    "dq24_foreign_key_summary",
    lambda spark, folder: all_orphans(spark, folder).groupBy("foreign_key").agg(
        F.count("*").alias("orphan_keys"), F.sum("child_rows").alias("child_rows")),
    f"SELECT foreign_key, count(*) AS orphan_keys, CAST(sum(child_rows) AS BIGINT) AS child_rows "
    f"FROM ({FOREIGN_KEY_SQL}) GROUP BY foreign_key",
)
