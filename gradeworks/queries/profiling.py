"""Profile tables on the case table, documents and events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeworks.operators import profiling as ops
from gradeworks.queries.cleaning import CONTENT, FLAWED, SOUND
from gradeworks.queries.learning import cross_fit_sql
from gradeworks.queries.registry import long_rows, long_sql, query, rounded
from gradeworks.queries.sampling import MD5
from gradeworks.session import stage
from gradeworks.sources.cases import CASES, cases, flawed_cases, stored_cases, table

COLUMNS = [x.strip() for x in CONTENT.split(",")]


@query(
    "ag02_class_shares",
    FLAWED
    + """SELECT grade, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 1) AS share_pct
    FROM flawed WHERE grade IS NOT NULL GROUP BY grade ORDER BY grade""",
)
def class_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.class_shares(flawed_cases(spark, sf_dir), CASES.label)


MISSING_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*) AS pct FROM flawed"
    for c in ("case_id", *COLUMNS, "rare_note", "grade")
)


@query(
    "ag03_missing_shares",
    FLAWED
    + f", gaps AS ({MISSING_SQL}) SELECT column_name, round(pct, 6) AS null_pct, pct > 40 AS flagged FROM gaps WHERE pct > 0",
)
def missing_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.missing_shares(flawed_cases(spark, sf_dir)).withColumnRenamed("column", "column_name"))


CORRELATED = ["total_price", "balance", "n_lines", "sum_qty", "avg_discount", "has_return", "has_open", "has_bulk", "grade"]
CORRELATION_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr({a}::DOUBLE, {b}::DOUBLE) AS r FROM cases"
    for i, b in enumerate(CORRELATED)
    for a in CORRELATED[:i]
)


@query(
    "ag07_correlations",
    SOUND + f", pairs AS ({CORRELATION_SQL}) SELECT a, b, round(r, 6) AS r, abs(r) >= 0.3 AS shown FROM pairs",
)
def correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    table_ = cases(spark, sf_dir).drop(*CASES.geo)
    return rounded(ops.correlation_table(table_, CASES), ["r"])


ENCODED = [*CORRELATED[:5], *CASES.geo, *CORRELATED[5:]]


@query(
    "ag07_correlations_with_geo",
    SOUND
    + f", folded AS (SELECT *, ntile(5) OVER (ORDER BY {MD5}) - 1 AS fold FROM cases),"
    + ",".join(cross_fit_sql("folded", c, f"by_{c}") for c in CASES.geo)
    + """, encoded AS (SELECT f.* REPLACE (r.encoding AS region_id, n.encoding AS nation_id, k.encoding AS customer_id)
      FROM folded f JOIN by_region_id r ON region_id = r.category AND f.fold = r.fold
      JOIN by_nation_id n ON nation_id = n.category AND f.fold = n.fold
      JOIN by_customer_id k ON customer_id = k.category AND f.fold = k.fold), pairs AS ("""
    + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, corr({a}::DOUBLE, {b}::DOUBLE) AS r FROM encoded"
        for i, b in enumerate(ENCODED)
        for a in ENCODED[:i]
    )
    + ") SELECT a, b, round(r, 6) AS r, abs(r) >= 0.3 AS shown FROM pairs",
)
def correlations_with_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.correlation_table(cases(spark, sf_dir), CASES), ["r"])


@query(
    "ag08_strongest",
    SOUND
    + f""", pairs AS ({CORRELATION_SQL})
    SELECT a AS feature, round(abs(r), 6) AS abs_r FROM pairs WHERE b = 'grade' ORDER BY abs(r) DESC LIMIT 10""",
)
def strongest(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = ops.correlations(cases(spark, sf_dir), CORRELATED)
    return rounded(ops.strongest(pairs, CASES.label), ["abs_r"])


BOXED = ["total_price", "balance", "n_lines", "sum_qty"]
BOX_SQL = " UNION ALL ".join(
    f"""SELECT q.grade AS class, '{c}' AS feature, q1, median, q3,
      least(min(c.{c}) FILTER (WHERE c.{c} >= q1 - 1.5 * (q3 - q1) AND c.{c} <= q3 + 1.5 * (q3 - q1)), q1) AS low,
      greatest(max(c.{c}) FILTER (WHERE c.{c} >= q1 - 1.5 * (q3 - q1) AND c.{c} <= q3 + 1.5 * (q3 - q1)), q3) AS high
    FROM (SELECT grade, quantile_cont({c}::DOUBLE, 0.25) AS q1, quantile_cont({c}::DOUBLE, 0.5) AS median,
      quantile_cont({c}::DOUBLE, 0.75) AS q3 FROM cases GROUP BY grade) q JOIN cases c ON c.grade = q.grade
    GROUP BY q.grade, q1, median, q3"""
    for c in BOXED
)


@query(
    "ag09_box_statistics",
    SOUND
    + f""", boxes AS ({BOX_SQL}) SELECT class, feature, round(q1, 6) AS q1, round(median, 6) AS median,
    round(q3, 6) AS q3, round(low, 6) AS low, round(high, 6) AS high FROM boxes""",
)
def box_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.box_statistics(cases(spark, sf_dir), BOXED, CASES.label))


@query(
    "ag10_contingency",
    SOUND
    + """SELECT priority, """
    + ", ".join(f"round(count(*) FILTER (WHERE grade = {c}) * 100.0 / count(*), 6) AS class_{c}" for c in (1, 2, 3))
    + " FROM cases GROUP BY priority",
)
def contingency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.contingency(cases(spark, sf_dir), "priority", CASES.label, CASES.classes))


@query(
    "ag10_contingency_documents",
    """SELECT lang, round(count(*) FILTER (WHERE quality = 0) * 100.0 / count(*), 6) AS class_0,
    round(count(*) FILTER (WHERE quality = 1) * 100.0 / count(*), 6) AS class_1
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY lang""",
)
def contingency_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id")
    return rounded(ops.contingency(judged, "lang", "quality", (0, 1)))


@query("ag11_region_counts", SOUND + "SELECT nation_id, count(*) AS n FROM cases GROUP BY nation_id ORDER BY nation_id")
def region_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.region_counts(cases(spark, sf_dir), "nation_id")


@query(
    "pf12_tail_share",
    FLAWED
    + """SELECT count(*) FILTER (WHERE total_price <= 300000) AS n_kept,
    round((count(*) - count(*) FILTER (WHERE total_price <= 300000)) * 100.0 / count(*), 6) AS excluded_pct FROM flawed""",
)
def tail_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.tail_share(flawed_cases(spark, sf_dir), "total_price", 300000))


@query(
    "pf13_class_slice",
    SOUND + "SELECT grade, count(*) AS n, round(avg(total_price), 6) AS mean_price FROM cases WHERE grade = 2 GROUP BY grade",
)
def class_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = cases(spark, sf_dir).where(F.col("grade") == 2)
    return rounded(chosen.groupBy("grade").agg(F.count(F.lit(1)).alias("n"), F.avg("total_price").alias("mean_price")))


@query(
    "ag12_density_histogram",
    """WITH span AS (SELECT event_type AS class, min(value) AS lo, (max(value) - min(value)) / 40 AS w,
      count(value) AS total FROM events GROUP BY event_type)
    SELECT class, CAST(least(floor((value - lo) / w), 39) AS INTEGER) AS bin, count(*) AS n,
      round(count(*) / (total * w), 6) AS density,
      round(lo + CAST(least(floor((value - lo) / w), 39) AS INTEGER) * w, 6) AS low
    FROM events JOIN span ON event_type = class GROUP BY class, lo, w, total, bin""",
)
def density_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.density_histogram(table(spark, sf_dir, "events"), "value", "event_type"))


@query(
    "ag13_skewness",
    "SELECT event_type, round(skewness(value), 6) AS skewness FROM events GROUP BY event_type",
)
def skewness(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_type = table(spark, sf_dir, "events").groupBy("event_type")
    return rounded(by_type.agg(ops.adjusted_skewness("value").alias("skewness")))


@query("ag29_distinct_classes", SOUND + "SELECT DISTINCT grade FROM cases ORDER BY grade")
def distinct_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.distinct_classes(cases(spark, sf_dir), CASES.label)


@query(
    "tk01_sorted_by_value",
    SOUND + "SELECT customer_id, count(*) AS n FROM cases GROUP BY customer_id ORDER BY n DESC, customer_id",
)
def sorted_by_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        cases(spark, sf_dir).groupBy("customer_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "customer_id")
    )


@query(
    "tk02_first_rows",
    SOUND + "SELECT case_id, total_price FROM cases ORDER BY total_price DESC, case_id LIMIT 5",
)
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cases(spark, sf_dir).select("case_id", "total_price").orderBy(F.desc("total_price"), "case_id").limit(5)


@query(
    "ml25_profile_bundle",
    FLAWED
    + f""", gaps AS ({MISSING_SQL}), shares AS (SELECT grade, count(*) AS n FROM flawed WHERE grade IS NOT NULL GROUP BY grade)
    SELECT 'class_shares' AS analysis, CAST(grade AS VARCHAR) AS item, CAST(n AS DOUBLE) AS value FROM shares
    UNION ALL SELECT 'missing_shares', column_name, round(pct, 6) FROM gaps WHERE pct > 0
    UNION ALL SELECT 'region_counts', CAST(region_id AS VARCHAR), CAST(count(*) AS DOUBLE) FROM flawed
      WHERE region_id IS NOT NULL GROUP BY region_id
    UNION ALL SELECT 'tail_share', 'n_kept', CAST(count(*) FILTER (WHERE total_price <= 300000) AS DOUBLE) FROM flawed
    UNION ALL SELECT 'skewness', 'total_price', round(skewness(total_price), 6) FROM flawed
    UNION ALL SELECT 'contingency_segment', segment, round(count(*) FILTER (WHERE grade = 1) * 100.0
      / count(*) FILTER (WHERE grade IS NOT NULL), 6) FROM flawed WHERE segment IS NOT NULL GROUP BY segment""",
)
def profile_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = ops.profile(stored_cases(spark, sf_dir), CASES, age="total_price", tail=300000)

    def rows(name: str, item: str, value: str) -> DataFrame:
        return tables[name].select(
            F.lit(name).alias("analysis"), F.expr(item).cast("string").alias("item"), F.expr(value).cast("double").alias("value")
        )

    return rounded(
        rows("class_shares", "grade", "n")
        .unionByName(rows("missing_shares", "`column`", "null_pct"))
        .unionByName(rows("region_counts", "region_id", "n"))
        .unionByName(rows("tail_share", "'n_kept'", "n_kept"))
        .unionByName(rows("skewness", "'total_price'", "skewness"))
        .unionByName(rows("contingency_segment", "segment", "class_1"))
    )


PROFILED = CASES.continuous
ENCODED_CASES = (
    SOUND
    + f", folded AS (SELECT *, ntile(5) OVER (ORDER BY {MD5}) - 1 AS fold FROM cases),"
    + ",".join(cross_fit_sql("folded", c, f"by_{c}") for c in CASES.geo)
    + """, encoded AS (SELECT f.* REPLACE (r.encoding AS region_id, n.encoding AS nation_id, k.encoding AS customer_id)
      FROM folded f JOIN by_region_id r ON region_id = r.category AND f.fold = r.fold
      JOIN by_nation_id n ON nation_id = n.category AND f.fold = n.fold
      JOIN by_customer_id k ON customer_id = k.category AND f.fold = k.fold), pairs AS ("""
    + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, corr({a}::DOUBLE, {b}::DOUBLE) AS r FROM encoded" for i, b in enumerate(ENCODED) for a in ENCODED[:i]
    )
    + ")"
)
GAPS_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*) AS null_pct FROM cases""" for c in ("case_id", *COLUMNS, "grade")
)
BOXES_SQL = " UNION ALL ".join(
    f"""SELECT q.grade AS class, '{c}' AS feature, q1, median, q3,
      least(min(c.{c}) FILTER (WHERE c.{c} >= q1 - 1.5 * (q3 - q1) AND c.{c} <= q3 + 1.5 * (q3 - q1)), q1) AS low,
      greatest(max(c.{c}) FILTER (WHERE c.{c} >= q1 - 1.5 * (q3 - q1) AND c.{c} <= q3 + 1.5 * (q3 - q1)), q3) AS high
    FROM (SELECT grade, quantile_cont({c}::DOUBLE, 0.25) AS q1, quantile_cont({c}::DOUBLE, 0.5) AS median,
      quantile_cont({c}::DOUBLE, 0.75) AS q3 FROM cases GROUP BY grade) q JOIN cases c ON c.grade = q.grade
    GROUP BY q.grade, q1, median, q3"""
    for c in PROFILED
)
CLASSES = [f"class_{c}" for c in CASES.classes]


def _shares_sql(column: str) -> str:
    shares = ", ".join(f"count(*) FILTER (WHERE grade = {c}) * 100.0 / count(*) AS class_{c}" for c in CASES.classes)
    return f"SELECT {column}, {shares} FROM cases WHERE {column} IS NOT NULL GROUP BY {column}"


TAIL = 300000
PROFILE_SQL = [
    long_sql("class_shares", "SELECT grade, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 1) AS share_pct FROM cases GROUP BY grade",
             ["grade"], ["n", "share_pct"]),
    long_sql("missing_shares", f"SELECT *, (null_pct > 40)::INT AS flagged FROM ({GAPS_SQL}) WHERE null_pct > 0", ['"column"'], ["null_pct", "flagged"]),
    long_sql("correlations", "SELECT a, b, r, (abs(r) >= 0.3)::INT AS shown FROM pairs", ["a", "b"], ["r", "shown"]),
    long_sql("strongest", "SELECT a AS feature, abs(r) AS abs_r FROM pairs WHERE b = 'grade' ORDER BY abs(r) DESC LIMIT 10", ["feature"], ["abs_r"]),
    long_sql("box_statistics", BOXES_SQL, ["class", "feature"], ["q1", "median", "q3", "low", "high"]),
    *[long_sql(f"contingency_{c}", _shares_sql(c), [c], CLASSES) for c in CASES.domains],
    long_sql("region_counts", "SELECT region_id, count(*) AS n FROM cases WHERE region_id IS NOT NULL GROUP BY region_id", ["region_id"], ["n"]),
    long_sql("region_shares", _shares_sql("region_id"), ["region_id"], CLASSES),
    long_sql("tail_share", f"""SELECT count(*) FILTER (WHERE total_price <= {TAIL}) AS n_kept,
      (count(*) - count(*) FILTER (WHERE total_price <= {TAIL})) * 100.0 / count(*) AS excluded_pct FROM cases""", [], ["n_kept", "excluded_pct"]),
    long_sql("density_histogram", f"""SELECT class, least(floor((x - lo) / w), 39)::INT AS bin, count(*) AS n, count(*) / (total * w) AS density,
        lo + least(floor((x - lo) / w), 39)::INT * w AS low
      FROM (SELECT grade AS class, total_price::DOUBLE AS x FROM cases WHERE total_price <= {TAIL}) v
      JOIN (SELECT grade AS c, min(total_price)::DOUBLE AS lo, (max(total_price) - min(total_price))::DOUBLE / 40 AS w, count(*) AS total
            FROM cases WHERE total_price <= {TAIL} GROUP BY grade) s ON class = c GROUP BY class, lo, w, total, bin""",
             ["class", "bin"], ["n", "density", "low"]),
    long_sql("skewness", "SELECT skewness(total_price) AS skewness FROM cases", [], ["skewness"]),
]
PROFILE_KEYS = {
    "class_shares": ["grade"], "missing_shares": ["column"], "correlations": ["a", "b"], "strongest": ["feature"],
    "box_statistics": ["class", "feature"], "region_counts": ["region_id"], "region_shares": ["region_id"],
    "density_histogram": ["class", "bin"], **{f"contingency_{c}": [c] for c in CASES.domains},
}


@query("ml25_profile_tables", ENCODED_CASES + " UNION ALL ".join(PROFILE_SQL))
def profile_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables of the profile in long form."""
    tables = ops.profile(stage(cases(spark, sf_dir), "cases"), CASES, age="total_price", tail=TAIL)
    return rounded(reduce(DataFrame.unionByName, [long_rows(n, t, PROFILE_KEYS.get(n, [])) for n, t in tables.items()]), ["value"])
