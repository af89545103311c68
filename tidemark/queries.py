"""Catalogue of the drift engine's queries and their DuckDB counterparts.

Every query runs an operator of the library over its whole frame; the SQL beside it says the same in another engine.
Doubles are rounded to six places on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import columns as C
from .operators import drift, evaluate, orientation, policy, profile, ranks, report, sampling
from .operators.held import holding
from .plans import preparation
from .plans.model import OnceFitted
from .sources.contract import ColumnContract
from .sources.frames import LINE_NUMBERS, ORDER_NUMBERS, ORDER_TEXTS, SPLIT, lines_frame, orders_frame, sides, table

FLAGSHIP = "num_ks_history"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
Q = Callable[[SparkSession, str], DataFrame]


def query(sql: str | None = None) -> Callable[[Q], Q]:
    def add(f: Q) -> Q:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(f.name, 6).alias(f.name) if isinstance(f.dataType, T.DoubleType | T.FloatType) else F.col(f.name) for f in df.schema.fields])


# ---------------------------------------------------------------- SQL that several queries share
# side: 1 is the current side, 0 the latest history block, -1 the one before, and so on.

ORDERS_SQL = """f AS (
  SELECT o_orderkey AS id, CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS INTEGER) AS p, o_orderdate >= TIMESTAMP '2001-01-01' AS now,
    CAST(o_totalprice + 200.0 * ((o_orderkey * 7919) % 1000) > 300000 AS INTEGER) AS y, o_totalprice, c_acctbal, o_orderpriority, c_mktsegment, n_name
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
d AS (SELECT p, CAST(floor((dense_rank() OVER (ORDER BY p) - 1) / 2) AS INTEGER) AS b FROM (SELECT DISTINCT p FROM f WHERE NOT now)),
g AS (SELECT f.*, CASE WHEN now THEN 1 ELSE d.b - (SELECT max(b) FROM d) END AS side FROM f LEFT JOIN d ON f.p = d.p)"""

LINES_SQL = """f AS (
  SELECT l_orderkey AS id, CAST(year(l_shipdate) * 12 + month(l_shipdate) - 1 AS INTEGER) AS p, l_shipdate >= TIMESTAMP '2001-01-01' AS now,
    CAST(l_returnflag = 'R' AS INTEGER) AS y, l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus
  FROM lineitem),
d AS (SELECT p, CAST(floor((dense_rank() OVER (ORDER BY p) - 1) / 2) AS INTEGER) AS b FROM (SELECT DISTINCT p FROM f WHERE NOT now)),
g AS (SELECT f.*, CASE WHEN now THEN 1 ELSE d.b - (SELECT max(b) FROM d) END AS side FROM f LEFT JOIN d ON f.p = d.p)"""


def long_sql(features: list[str], expression: str = "{f}", kind: str = "DOUBLE", source: str = "g") -> str:
    parts = [f"SELECT id, p, now, y, side, '{f}' AS feature, CAST({expression.format(f=f)} AS {kind}) AS v FROM {source}" for f in features]
    return "l AS (" + " UNION ALL ".join(parts) + ")"


#: From l: s (feature, side, share below or at v) for all sides, then the statistic of sides i and i + 1.
KS_SQL = """n AS (SELECT feature, v, side, count(*) AS c FROM l WHERE v IS NOT NULL GROUP BY ALL),
t AS (SELECT feature, side, sum(c) AS t FROM n GROUP BY ALL),
grid AS (SELECT x.feature, x.v, t.side, t.t, coalesce(n.c, 0) AS c FROM (SELECT DISTINCT feature, v FROM n) x JOIN t ON t.feature = x.feature LEFT JOIN n ON n.feature = x.feature AND n.v = x.v AND n.side = t.side),
s AS (SELECT feature, v, side, sum(c) OVER (PARTITION BY feature, side ORDER BY v) / t AS share FROM grid),
ks AS (SELECT a.feature, a.side, max(abs(a.share - b.share)) AS ks FROM s a JOIN s b ON a.feature = b.feature AND a.v = b.v AND b.side = a.side + 1 GROUP BY ALL)"""

#: From l (text): shares of canonical levels and the distance of sides i and i + 1.
TV_SQL = """n AS (SELECT feature, v, side, count(*) AS c FROM l GROUP BY ALL),
t AS (SELECT feature, side, sum(c) AS t FROM n GROUP BY ALL),
grid AS (SELECT x.feature, x.v, t.side, coalesce(n.c, 0) / t.t AS share FROM (SELECT DISTINCT feature, v FROM n) x JOIN t ON t.feature = x.feature LEFT JOIN n ON n.feature = x.feature AND n.v = x.v AND n.side = t.side),
ks AS (SELECT a.feature, a.side, 0.5 * sum(abs(a.share - b.share)) AS ks FROM grid a JOIN grid b ON a.feature = b.feature AND a.v = b.v AND b.side = a.side + 1 GROUP BY ALL)"""

CANON = "coalesce(nullif(lower(trim(coalesce({f}, ''), chr(32) || chr(9) || chr(10) || chr(13) || chr(12) || chr(11))), ''), '__missing__')"
SHIFT_COLUMNS = """feature, round(max(CASE WHEN side = 0 THEN ks END), 6) AS current_shift, round(max(CASE WHEN side < 0 THEN ks END), 6) AS historical_max_shift,
  round(max(CASE WHEN side = 0 THEN ks END) / (max(CASE WHEN side < 0 THEN ks END) + 0.01), 6) AS novelty_ratio"""


def _numeric_shift(frame: DataFrame, features: list[str]) -> DataFrame:
    """Shift of numeric features, computed at once: a row for each feature."""
    counts, blocks = _counts(frame, features, True)
    with holding() as hold:
        return drift.frozen(drift.numeric_shift(hold(counts), blocks))


def _shift(one: DataFrame) -> DataFrame:
    return rounded(one.select("feature", "current_shift", "historical_max_shift", C.novelty(F.col("current_shift"), F.col("historical_max_shift")).alias("novelty_ratio")))


def _counts(frame: DataFrame, features: list[str], numeric: bool) -> tuple[DataFrame, profile.Blocks]:
    train, current = sides(frame)
    blocks = profile.history_blocks(train)
    return profile.counted(train, current, features, numeric, blocks, "target"), blocks


# ---------------------------------------------------------------- periods, text, labels


@query(f"""WITH {ORDERS_SQL} SELECT p AS period_idx, CAST(dense_rank() OVER (ORDER BY p) - 1 AS BIGINT) AS position, b AS block_idx FROM d""")
def period_dim_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.period_blocks(sides(orders_frame(spark, sf_dir))[0]).withColumn("position", F.col("position").cast("long"))


@query("""SELECT l AS label, CAST((2000 + CAST(substr(l, 1, 2) AS INTEGER)) * 12 + (instr('janfebmaraprmayjunjulaugsepoctnovdec', lower(substr(l, 4, 3))) - 1) // 3 AS INTEGER) AS period_idx, count(*) AS n
FROM (SELECT strftime(o_orderdate, '%y-%b') AS l FROM orders) GROUP BY ALL""")
def month_parse_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(C.period_label(F.col("o_orderdate")).alias("label"))
    return o.groupBy("label").agg(F.count("*").alias("n")).withColumn("period_idx", C.parse_period(F.col("label"))).orderBy("period_idx").select("label", "period_idx", "n")


@query(f"""SELECT p_partkey, {CANON.format(f="raw")} AS level FROM (
  SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 11 = 0 THEN chr(9) || ' ' WHEN p_partkey % 2 = 0 THEN ' ' || upper(p_type) || chr(10) ELSE p_type END AS raw FROM part)""")
def canonical_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, kind = F.col("p_partkey"), F.col("p_type")
    raw = F.when(key % 7 == 0, F.lit(None)).when(key % 11 == 0, F.lit("\t ")).when(key % 2 == 0, F.concat(F.lit(" "), F.upper(kind), F.lit("\n"))).otherwise(kind)
    return table(spark, sf_dir, "part").select("p_partkey", C.canonical_category(raw).alias("level"))


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN 1 ELSE -1 END AS target FROM orders""")
def target_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey") % 4
    raw = F.when(k == 0, F.lit(" YES ")).when(k == 1, F.lit("no")).when(k == 2, F.lit("Yes\t")).otherwise(F.lit("maybe"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.coalesce(C.yes_no(raw), F.lit(-1)).alias("target"))


@query("""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 0 WHEN 4 THEN 1 ELSE -1 END AS label FROM orders""")
def label_parse_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey") % 6
    raw = F.when(k == 0, F.lit("Y")).when(k == 1, F.lit("n")).when(k == 2, F.lit("1")).when(k == 3, F.lit("0.0")).when(k == 4, F.lit("yes")).otherwise(F.lit("2"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.coalesce(C.lenient_label(raw), F.lit(-1)).alias("label"))


@query("""SELECT CAST(count(*) AS BIGINT) AS row_count, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS ids, round(sum(o_totalprice), 2) AS total FROM orders""")
def scan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").agg(F.count("*").alias("row_count"), F.count_distinct("o_orderkey").alias("ids"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query(f"""WITH {ORDERS_SQL}, l AS (SELECT DISTINCT lower(trim(o_orderpriority)) AS level, now FROM f)
SELECT level, bool_or(NOT now) AS in_train, bool_or(now) AS in_current FROM l GROUP BY level""")
def domain_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, current = sides(orders_frame(spark, sf_dir))
    level = C.canonical_category(F.col("o_orderpriority")).alias("level")
    both = train.select(level, F.lit(False).alias("now")).unionByName(current.select(level, F.lit(True).alias("now")))
    return both.groupBy("level").agg(F.bool_or(~F.col("now")).alias("in_train"), F.bool_or("now").alias("in_current"))


@query("""SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def dup_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("copies")).where("copies > 1")


# ---------------------------------------------------------------- shift and history


@query(f"WITH {ORDERS_SQL}, {long_sql(ORDER_NUMBERS)}, {KS_SQL} SELECT {SHIFT_COLUMNS} FROM ks GROUP BY feature")
def num_ks_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shift(_numeric_shift(orders_frame(spark, sf_dir), ORDER_NUMBERS))


@query(f"WITH {LINES_SQL}, {long_sql(LINE_NUMBERS)}, {KS_SQL} SELECT {SHIFT_COLUMNS} FROM ks GROUP BY feature")
def num_ks_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shift(_numeric_shift(lines_frame(spark, sf_dir), LINE_NUMBERS))


@query(f"WITH {ORDERS_SQL}, {long_sql(ORDER_TEXTS, CANON, 'VARCHAR')}, {TV_SQL} SELECT {SHIFT_COLUMNS} FROM ks GROUP BY feature")
def cat_tv_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts, blocks = _counts(orders_frame(spark, sf_dir), ORDER_TEXTS, False)
    return _shift(drift.categorical_shift(profile.with_canonical(counts), blocks))


@query(f"""WITH {LINES_SQL}, {long_sql(LINE_NUMBERS)}, {KS_SQL} SELECT feature, CAST(side + (SELECT max(b) FROM d) AS INTEGER) AS position, round(ks, 6) AS shift FROM ks WHERE side < 0""")
def history_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = _numeric_shift(lines_frame(spark, sf_dir), LINE_NUMBERS)
    pairs = F.array(*[F.struct(F.lit(i).alias("position"), F.col(h).alias("shift")) for i, h in enumerate(c for c in one.columns if c.startswith("h_"))])
    return rounded(one.select("feature", F.explode(pairs).alias("p")).select("feature", "p.*"))


@query(f"""WITH {ORDERS_SQL}, m AS (SELECT DISTINCT o.l, d.p, d.b FROM d JOIN (SELECT DISTINCT strftime(o_orderdate, '%y-%b') AS l, CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS INTEGER) AS p FROM orders) o ON o.p = d.p)
SELECT b AS block_idx, CASE WHEN count(*) = 1 THEN min(l) ELSE arg_min(l, p) || '–' || arg_max(l, p) END AS label, CAST(count(*) AS INTEGER) AS periods FROM m GROUP BY b""")
def history_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = profile.period_blocks(sides(orders_frame(spark, sf_dir))[0])
    names = table(spark, sf_dir, "orders").select(C.period_label(F.col("o_orderdate")).alias("l"), C.period_of(F.col("o_orderdate")).alias("period_idx")).distinct()
    each = blocks.join(names, "period_idx").groupBy("block_idx").agg(F.array_sort(F.collect_list(F.struct("period_idx", "l"))).alias("m"))
    return each.select("block_idx", C.block_label(F.col("m.l")).alias("label"), F.size("m").alias("periods"))


@query(f"""WITH {LINES_SQL}, r AS (SELECT now, l_extendedprice AS v, row_number() OVER (PARTITION BY now ORDER BY l_extendedprice, id) - 1 AS pos, count(*) OVER (PARTITION BY now) AS n FROM f),
k AS (SELECT i FROM range(0, 4096) AS x(i))
SELECT now, count(*) AS n, round(sum(v), 2) AS total FROM r WHERE n <= 4096 OR pos IN (SELECT CAST(floor(i * (r2.n - 1) / 4095.0) AS BIGINT) FROM k, (SELECT DISTINCT now, n FROM r) r2 WHERE r2.now = r.now) GROUP BY now""")
def ks_thinned(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = lines_frame(spark, sf_dir).select("now", F.col("l_extendedprice").alias("v"), "id")
    return ranks.evenly_spaced(ordered, ["now"], "v", ["v", "id"]).groupBy("now").agg(F.count("*").alias("n"), F.round(F.sum("v"), 2).alias("total"))


# ---------------------------------------------------------------- missingness, support, quantiles

NULLED = "CASE WHEN now AND (id * 13) % 10 < 7 THEN NULL WHEN id % 9 = 0 THEN NULL ELSE {f} END"


def nulled(frame: DataFrame, features: list[str]) -> DataFrame:
    hole = (F.col("now") & (F.col("id") * 13 % 10 < 7)) | (F.col("id") % 9 == 0)
    return frame.withColumns({f: F.when(~hole, F.col(f)) for f in features})


MISSING_SQL = """m AS (SELECT feature, side, avg(CAST(v IS NULL AS DOUBLE)) AS r FROM l GROUP BY ALL),
j AS (SELECT a.feature, a.side, abs(a.r - b.r) AS ks FROM m a JOIN m b ON a.feature = b.feature AND b.side = a.side + 1)"""


@query(f"""WITH {ORDERS_SQL}, {long_sql(ORDER_NUMBERS, NULLED)}, {MISSING_SQL}
SELECT feature, round(max(CASE WHEN side = 0 THEN ks END), 6) AS missing_shift, round(max(CASE WHEN side < 0 THEN ks END), 6) AS historical_missing_shift,
  round(max(CASE WHEN side = 0 THEN ks END) / (max(CASE WHEN side < 0 THEN ks END) + 0.01), 6) AS missing_novelty_ratio FROM j GROUP BY feature""")
def missing_rates_by_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts, blocks = _counts(nulled(orders_frame(spark, sf_dir), ORDER_NUMBERS), ORDER_NUMBERS, True)
    return rounded(drift.missing_shift(counts, blocks))


SUPPORT_SQL = """u AS (SELECT feature, count(DISTINCT CASE WHEN NOT now THEN v END) AS unique_values, count(DISTINCT CASE WHEN side = 0 THEN v END) AS recent_unique_values,
  count(DISTINCT CASE WHEN now THEN v END) AS test_unique_values, count(CASE WHEN now THEN v END) AS current_non_missing FROM l GROUP BY feature)"""


@query(f"""WITH {ORDERS_SQL}, {long_sql([*ORDER_NUMBERS, *ORDER_TEXTS], NULLED, "VARCHAR")}, {SUPPORT_SQL}
SELECT *, round(least(1.0, test_unique_values / greatest(1, least(recent_unique_values, current_non_missing))), 6) AS support_retention_ratio FROM u""")
def nunique_support_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = nulled(orders_frame(spark, sf_dir), [*ORDER_NUMBERS, *ORDER_TEXTS])
    a, blocks = _counts(frame, ORDER_NUMBERS, True)
    b, _ = _counts(frame, ORDER_TEXTS, False)
    recent = drift.recent_counter(blocks)
    return rounded(profile.support(a, recent).unionByName(profile.support(b, recent)))


@query(f"""WITH {LINES_SQL}, {long_sql(LINE_NUMBERS)} SELECT feature, round(quantile_cont(v, 0.1), 6) AS q10, round(quantile_cont(v, 0.25), 6) AS q25, round(quantile_cont(v, 0.5), 6) AS q50,
  round(quantile_cont(v, 0.75), 6) AS q75, round(quantile_cont(v, 0.9), 6) AS q90 FROM l WHERE now GROUP BY feature""")
def quantile_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts, blocks = _counts(lines_frame(spark, sf_dir), LINE_NUMBERS, True)
    cum = profile.cumulative(counts, ["n_current"])
    return rounded(cum.groupBy("feature").agg(*[drift.quantile("n_current", p).alias(n) for n, p in zip(("q10", "q25", "q50", "q75", "q90"), drift.PROBABILITIES, strict=True)]))


def _representation_sql(moved: str) -> str:
    return f"""WITH {LINES_SQL}, {long_sql(["l_extendedprice", "l_quantity"], moved)},
w AS (SELECT feature, side, v FROM l WHERE side >= 0),
q AS (SELECT feature, quantile_cont(CASE WHEN side = 0 THEN v END, [0.1, 0.25, 0.5, 0.75, 0.9]) AS r, quantile_cont(CASE WHEN side = 1 THEN v END, [0.1, 0.25, 0.5, 0.75, 0.9]) AS c FROM w GROUP BY feature),
e AS (SELECT feature, r, c, r[4] - r[2] AS sr, c[4] - c[2] AS sc FROM q),
z AS (SELECT w.feature, side, CASE WHEN side = 0 THEN (v - r[3]) / sr ELSE (v - c[3]) / sc END AS v FROM w JOIN e ON e.feature = w.feature),
nz AS (SELECT feature, v, count(*) FILTER (side = 0) AS a, count(*) FILTER (side = 1) AS b FROM z GROUP BY ALL),
cz AS (SELECT feature, sum(a) OVER x / sum(a) OVER (PARTITION BY feature) - sum(b) OVER x / sum(b) OVER (PARTITION BY feature) AS gap FROM nz WINDOW x AS (PARTITION BY feature ORDER BY v)),
k AS (SELECT feature, max(abs(gap)) AS shape FROM cz GROUP BY feature)
SELECT e.feature, round(shape, 6) AS shape_ks, round(sc / sr, 6) AS spread_ratio,
  round(greatest(abs(c[1] * sr / sc - r[1]), abs(c[2] * sr / sc - r[2]), abs(c[3] * sr / sc - r[3]), abs(c[4] * sr / sc - r[4]), abs(c[5] * sr / sc - r[5])) / sr, 6) AS scale_alignment_error,
  round(greatest(abs(c[1] - c[3] + r[3] - r[1]), abs(c[2] - c[3] + r[3] - r[2]), abs(c[4] - c[3] + r[3] - r[4]), abs(c[5] - c[3] + r[3] - r[5])) / sr, 6) AS offset_alignment_error,
  round(abs(c[3] - r[3]) / sr, 6) AS offset_spread_multiples,
  shape <= 0.10 AND (sc / sr >= 5 OR sc / sr <= 0.2) AND greatest(abs(c[1] * sr / sc - r[1]), abs(c[2] * sr / sc - r[2]), abs(c[3] * sr / sc - r[3]), abs(c[4] * sr / sc - r[4]), abs(c[5] * sr / sc - r[5])) / sr <= 0.35 AS scale_repair_safe,
  shape <= 0.10 AND sc / sr BETWEEN 0.8 AND 1.25 AND abs(c[3] - r[3]) / sr >= 6
    AND greatest(abs(c[1] - c[3] + r[3] - r[1]), abs(c[2] - c[3] + r[3] - r[2]), abs(c[4] - c[3] + r[3] - r[4]), abs(c[5] - c[3] + r[3] - r[5])) / sr <= 0.35 AS offset_repair_safe
FROM e JOIN k ON k.feature = e.feature"""


def _representation(spark: SparkSession, sf_dir: str, moved) -> DataFrame:
    frame = lines_frame(spark, sf_dir)
    features = ["l_extendedprice", "l_quantity"]
    counts, blocks = _counts(frame.withColumns({f: F.when(F.col("now"), moved(F.col(f))).otherwise(F.col(f)) for f in features}), features, True)
    recent = drift.recent_counter(blocks)
    one = drift.representation(profile.cumulative(counts, [recent, "n_current"]), recent)
    return rounded(one.drop("enough_observations", "scale_factor", "offset"))


@query(_representation_sql("CASE WHEN now THEN {f} * 100 ELSE {f} END"))
def scale_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _representation(spark, sf_dir, lambda c: c * 100)


@query(_representation_sql("CASE WHEN now THEN {f} + 2000000 ELSE {f} END"))
def offset_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _representation(spark, sf_dir, lambda c: c + 2000000)


# ---------------------------------------------------------------- relabelling

TIERS = "CASE WHEN id % 10 < 6 THEN 'a' WHEN id % 10 < 9 THEN 'b' ELSE 'c' END"
RELABELLED = f"CASE WHEN now THEN 'new_' || ({TIERS}) ELSE {TIERS} END"


def tiers(frame: DataFrame) -> DataFrame:
    k = F.col("id") % 10
    tier = F.when(k < 6, F.lit("a")).when(k < 9, F.lit("b")).otherwise(F.lit("c"))
    return frame.withColumn("tier", F.when(F.col("now"), F.concat(F.lit("new_"), tier)).otherwise(tier))


REMAP_SQL = f"""WITH {ORDERS_SQL}, l AS (SELECT side, {RELABELLED} AS v FROM g WHERE side >= 0),
a AS (SELECT v, count(*) / sum(count(*)) OVER () AS p, row_number() OVER (ORDER BY count(*) DESC, v) AS r FROM l WHERE side = 0 GROUP BY v),
b AS (SELECT v, count(*) / sum(count(*)) OVER () AS q, row_number() OVER (ORDER BY count(*) DESC, v) AS r FROM l WHERE side = 1 GROUP BY v),
j AS (SELECT a.v AS reference, b.v AS observed, p, q, r, least(lag(p) OVER (ORDER BY r) - p, lag(q) OVER (ORDER BY r) - q) AS gap FROM a JOIN b USING (r)),
u AS (SELECT coalesce((SELECT avg(CAST(v IN (SELECT v FROM a) AS DOUBLE)) FROM l WHERE side = 1), 0.0) AS support,
  least((SELECT count(*) FROM l WHERE side = 0), (SELECT count(*) FROM l WHERE side = 1)) AS n, (SELECT count(*) FROM a) AS d_r, (SELECT count(*) FROM b) AS d_c)"""


@query(REMAP_SQL + """ SELECT 'tier' AS feature, round((SELECT CAST(support AS DOUBLE) FROM u), 6) AS remap_support,
  (SELECT n >= 200 AND d_r BETWEEN 2 AND 25 AND d_r = d_c AND support <= 0.15 FROM u) AS compatible_cardinality, round(0.5 * sum(abs(p - q)), 6) AS frequency_structure_tv, round(min(gap), 6) AS minimum_frequency_gap,
  0.5 * sum(abs(p - q)) <= 0.08 AND min(gap) >= 0.05 AS category_remap_safe,
  round(CASE WHEN 0.5 * sum(abs(p - q)) <= 0.08 AND min(gap) >= 0.05 THEN least(1.0, min(gap) / 0.1) * greatest(0.0, 1 - 0.5 * sum(abs(p - q)) / 0.08) ELSE 0.0 END, 6) AS mapping_confidence FROM j""")
def remap_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts, blocks = _counts(tiers(orders_frame(spark, sf_dir)), ["tier"], False)
    return rounded(drift.remap(profile.with_canonical(counts), drift.recent_counter(blocks)).drop("category_mapping"))


@query(REMAP_SQL + " SELECT 'tier' AS feature, observed, reference FROM j WHERE (SELECT 0.5 * sum(abs(p - q)) <= 0.08 AND min(gap) >= 0.05 FROM j)")
def remap_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts, blocks = _counts(tiers(orders_frame(spark, sf_dir)), ["tier"], False)
    one = drift.remap(profile.with_canonical(counts), drift.recent_counter(blocks))
    return one.select("feature", F.explode("category_mapping").alias("observed", "reference"))


@query(f"""WITH {ORDERS_SQL}, l AS (SELECT side, CASE WHEN now AND id % 3 = 0 THEN 'x' || c_mktsegment ELSE c_mktsegment END AS v FROM g)
SELECT 'segment' AS feature, round(avg(CAST(v IN (SELECT v FROM l WHERE side = 0) AS DOUBLE)), 6) AS known_category_support_ratio FROM l WHERE side = 1""")
def known_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    strange = F.when(F.col("now") & (F.col("id") % 3 == 0), F.concat(F.lit("x"), "c_mktsegment")).otherwise(F.col("c_mktsegment"))
    counts, blocks = _counts(orders_frame(spark, sf_dir).withColumn("segment", strange), ["segment"], False)
    return rounded(drift.known_support(profile.with_canonical(counts), drift.recent_counter(blocks)))


# ---------------------------------------------------------------- signal

STRENGTH_SQL = """r AS (SELECT feature, y, rank() OVER (PARTITION BY feature ORDER BY v) + (count(*) OVER (PARTITION BY feature, v) - 1) / 2.0 AS x FROM l WHERE NOT now AND v IS NOT NULL),
strength AS (SELECT feature, abs(corr(x, y)) AS predictive_strength FROM r GROUP BY feature)"""


@query(f"WITH {ORDERS_SQL}, {long_sql(ORDER_NUMBERS, NULLED)}, {STRENGTH_SQL} SELECT feature, round(predictive_strength, 6) AS predictive_strength FROM strength")
def spearman_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts, _ = _counts(nulled(orders_frame(spark, sf_dir), ORDER_NUMBERS), ORDER_NUMBERS, True)
    return rounded(drift.rank_correlation_with_target(profile.cumulative(counts, ["n_train"])))


@query("""WITH r AS (SELECT l_returnflag AS flag, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2.0 AS a,
  rank() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_returnflag, l_extendedprice) - 1) / 2.0 AS b FROM lineitem)
SELECT flag, round(corr(a, b), 6) AS spearman FROM r GROUP BY flag""")
def spearman_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("flag"), "l_quantity", "l_extendedprice")
    return rounded(drift.spearman(x, "l_quantity", "l_extendedprice", ["flag"]))


RATE_SPREAD_SQL = """c AS (SELECT feature, v, count(*) AS n, avg(y) AS r FROM l WHERE NOT now GROUP BY ALL),
k AS (SELECT *, greatest(30, floor(sum(n) OVER (PARTITION BY feature) * 0.0004)) AS least FROM c),
w AS (SELECT feature, n, r, sum(n * r) OVER (PARTITION BY feature) / sum(n) OVER (PARTITION BY feature) AS m FROM k WHERE n >= least),
strength AS (SELECT feature, CASE WHEN count(*) >= 2 THEN sqrt(sum(n * (r - m) * (r - m)) / sum(n)) ELSE 0.0 END AS predictive_strength FROM w GROUP BY feature)"""


@query(f"WITH {ORDERS_SQL}, {long_sql(ORDER_TEXTS, CANON, 'VARCHAR')}, {RATE_SPREAD_SQL} SELECT feature, round(predictive_strength, 6) AS predictive_strength FROM strength")
def cat_predictive_strength(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts, _ = _counts(orders_frame(spark, sf_dir), ORDER_TEXTS, False)
    return rounded(drift.level_rate_spread(profile.with_canonical(counts)))


# ---------------------------------------------------------------- evidence as a whole

SCALED = "CASE WHEN now AND '{f}' = 'o_totalprice' THEN {f} * 100 ELSE {f} END"


def scaled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_frame(spark, sf_dir).withColumn("o_totalprice", F.when(F.col("now"), F.col("o_totalprice") * 100).otherwise(F.col("o_totalprice")))


EVIDENCE_SQL = f"""WITH {ORDERS_SQL}, {long_sql(ORDER_NUMBERS, SCALED)}, {KS_SQL}, {MISSING_SQL}, {SUPPORT_SQL}, {STRENGTH_SQL},
e AS (SELECT feature, max(CASE WHEN side = 0 THEN ks END) AS cur, max(CASE WHEN side < 0 THEN ks END) AS his FROM ks GROUP BY feature),
mm AS (SELECT feature, max(CASE WHEN side = 0 THEN ks END) AS cur, max(CASE WHEN side < 0 THEN ks END) AS his FROM j GROUP BY feature),
ev AS (SELECT e.feature, 'numeric' AS kind, e.cur AS current_shift, e.his AS historical_max_shift, e.cur / (e.his + 0.01) AS novelty_ratio, predictive_strength, unique_values, recent_unique_values, test_unique_values,
    mm.cur AS missing_shift, mm.cur / (mm.his + 0.01) AS missing_novelty,
    e.cur >= 0.10 AND e.cur / (e.his + 0.01) >= 2 AND NOT (mm.cur >= greatest(0.05, 0.5 * e.cur) AND mm.cur / (mm.his + 0.01) >= 2) AS unusual_movement
  FROM e JOIN mm ON mm.feature = e.feature JOIN u ON u.feature = e.feature JOIN strength s ON s.feature = e.feature)"""


def _numeric_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, current = sides(scaled_orders(spark, sf_dir))
    return drift.base_evidence(train, current, ORDER_NUMBERS, [], profile.history_blocks(train), "target")


@query(EVIDENCE_SQL + """ SELECT feature, kind, round(current_shift, 6) AS current_shift, round(historical_max_shift, 6) AS historical_max_shift, round(novelty_ratio, 6) AS novelty_ratio,
  round(predictive_strength, 6) AS predictive_strength, unique_values, recent_unique_values, test_unique_values, round(missing_shift, 6) AS missing_shift, unusual_movement,
  CASE WHEN missing_shift >= 0.1 AND missing_novelty >= 2 AND predictive_strength >= 0.06 THEN 'REVIEW_MISSINGNESS' WHEN unusual_movement AND predictive_strength >= 0.06 THEN 'REVIEW_NOVEL' ELSE 'KEEP' END AS action FROM ev""")
def base_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = _numeric_evidence(spark, sf_dir)
    return rounded(one.select("feature", "kind", "current_shift", "historical_max_shift", "novelty_ratio", "predictive_strength", "unique_values", "recent_unique_values", "test_unique_values", "missing_shift", "unusual_movement", "action"))


@query(EVIDENCE_SQL + """ SELECT feature, unusual_movement, round(avg(CASE WHEN unique_values > 1 THEN CAST(unusual_movement AS DOUBLE) END) OVER (), 6) AS systemic_drift_fraction,
  avg(CASE WHEN unique_values > 1 THEN CAST(unusual_movement AS DOUBLE) END) OVER () >= 0.4 AS systemic_drift_active FROM ev""")
def systemic_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(drift.add_systemic(_numeric_evidence(spark, sf_dir)).select("feature", "unusual_movement", "systemic_drift_fraction", "systemic_drift_active"))


@query()
def detect_and_decide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole detection and policy over injected scale and relabelling drift (rows only: the parts above have SQL)."""
    train, current = sides(tiers(scaled_orders(spark, sf_dir)))
    blocks = profile.history_blocks(train)
    found = orientation.detect_drift(train, current, ORDER_NUMBERS, [*ORDER_TEXTS, "tier"], blocks, "target")
    return rounded(policy.choose_actions(found).select("feature", "kind", "current_shift", "novelty_ratio", "action", "reason"))


# ---------------------------------------------------------------- label rates, anchors, direction

REFERENCE_SQL = "ref AS (SELECT * FROM f WHERE NOT now AND p < (SELECT max(p) FROM f WHERE NOT now) - 1), gl AS (SELECT avg(y) AS g FROM ref)"


def _reference(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(reference, recent, current)."""
    train, current = sides(orders_frame(spark, sf_dir))
    latest = F.col("period_idx").isin(*profile.history_blocks(train).recent_periods())
    return train.where(~latest), train.where(latest), current


EDGES_SQL = "ed AS (SELECT list_sort(list_distinct(quantile_cont(o_totalprice, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e FROM ref), inn AS (SELECT e[2:len(e) - 1] AS i FROM ed), ie AS (SELECT unnest(i) AS x FROM inn)"
RATES_SQL = "rt AS (SELECT bucket, count(*) AS n, (sum(y) + 200 * max(g)) / (count(*) + 200) AS rate FROM (SELECT y, (SELECT count(*) FROM ie WHERE x < o_totalprice) AS bucket FROM ref), gl GROUP BY bucket)"


@query(f"WITH {ORDERS_SQL}, {REFERENCE_SQL}, {EDGES_SQL}, {RATES_SQL} SELECT 'o_totalprice' AS feature, CAST(bucket AS INTEGER) AS bucket, n, round(rate, 6) AS rate FROM rt")
def label_rate_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(orientation.numeric_label_rates(_reference(spark, sf_dir)[0], ["o_totalprice"], "target"))


@query(f"""WITH {ORDERS_SQL}, {REFERENCE_SQL} SELECT feature, v AS level, count(*) AS n, round((sum(y) + 200 * max(g)) / (count(*) + 200), 6) AS rate FROM (
  SELECT 'o_orderpriority' AS feature, lower(trim(o_orderpriority)) AS v, y FROM ref UNION ALL SELECT 'n_name', lower(trim(n_name)), y FROM ref), gl GROUP BY ALL""")
def label_rate_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(orientation.category_label_rates(_reference(spark, sf_dir)[0], ["o_orderpriority", "n_name"], "target"))


@query(f"""WITH {ORDERS_SQL}, {REFERENCE_SQL}, {EDGES_SQL}, {RATES_SQL}
SELECT id, round(coalesce((SELECT rate FROM rt WHERE rt.bucket = (SELECT count(*) FROM ie WHERE x < o_totalprice)), g), 6) AS score FROM f, gl WHERE now""")
def label_rate_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference, _, current = _reference(spark, sf_dir)
    anchor = orientation.profiles(reference, ["o_totalprice"], [], "target")[0]
    return rounded(current.select("id", anchor.score().alias("score")))


@query(f"WITH {LINES_SQL}, {long_sql(LINE_NUMBERS)}, {STRENGTH_SQL} SELECT feature, round(predictive_strength, 6) AS predictive_strength, CAST(row_number() OVER (ORDER BY predictive_strength DESC, feature) AS INTEGER) AS anchor_rank FROM strength")
def anchor_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts, _ = _counts(lines_frame(spark, sf_dir), LINE_NUMBERS, True)
    return rounded(orientation.top_anchors(drift.rank_correlation_with_target(profile.cumulative(counts, ["n_train"]))))


NOISY = 10


@query(f"""WITH {ORDERS_SQL}, rk AS (SELECT id, p, o_totalprice + 30.0 * ((id * 7919) % 1000) AS a, rank() OVER (PARTITION BY p ORDER BY o_totalprice) AS r, count(*) OVER (PARTITION BY p, o_totalprice) AS t, count(*) OVER (PARTITION BY p) AS n FROM f WHERE now),
pr AS (SELECT a, (r + (t - 1) / 2.0) / n AS x FROM rk),
z AS (SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS u, rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0 AS w FROM pr)
SELECT 'o_totalprice' AS feature, round(corr(u, w), 6) AS spearman FROM z""")
def orientation_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spearman of the rank within the period and a stable score of the same row."""
    current = orders_frame(spark, sf_dir).where("now").withColumn("score", F.col("o_totalprice") + 30.0 * (F.col("id") * 7919 % 1000))
    with_rank = ranks.with_percentile(current, "period_idx", "o_totalprice", "pr").withColumn("feature", F.lit("o_totalprice"))
    return rounded(drift.spearman(with_rank, "pr", "score", ["feature"]))


@query()
def orientation_reversal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full direction path: a reversed price among noisy copies of itself that stay (rows only)."""
    frame = orders_frame(spark, sf_dir)
    noise = lambda i: F.col("o_totalprice") + 40000.0 * (F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / 1000)
    frame = frame.withColumns({f"copy{i}": noise(i) for i in range(NOISY)})
    frame = frame.withColumn("turned", F.when(F.col("now"), -F.col("o_totalprice") + 700000).otherwise(F.col("o_totalprice"))).drop("o_totalprice")
    train, current = sides(frame)
    features = ["turned", *[f"copy{i}" for i in range(NOISY)]]
    found = orientation.detect_drift(train, current, features, [], profile.history_blocks(train), "target")
    return rounded(policy.choose_actions(found).select("feature", "current_shift", "novelty_ratio", "orientation_train", "orientation_test", "orientation_anchor_count", "action"))


# ---------------------------------------------------------------- policy

POLICY_ROWS = """p AS (SELECT p_partkey AS k, p_partkey % 3 AS r, CASE WHEN p_partkey % 2 = 0 THEN 'numeric' ELSE 'categorical' END AS kind, (p_partkey // 6) % 5 AS q, p_partkey % 7 AS s, p_partkey % 11 AS t FROM part)"""


@query(f"""WITH {POLICY_ROWS}, a AS (SELECT k, CASE
  WHEN r = 2 THEN 'KEEP'
  WHEN kind = 'numeric' AND s = 1 AND q = 1 THEN 'REVERSE_PERCENTILE'
  WHEN r = 0 AND kind = 'numeric' AND q = 2 THEN 'REALIGN_SCALE'
  WHEN r = 0 AND kind = 'numeric' AND q = 3 THEN 'REALIGN_OFFSET'
  WHEN r = 0 AND kind = 'categorical' AND q = 4 THEN 'REMAP_CATEGORIES'
  WHEN t = 0 THEN 'KEEP_SYSTEMIC_DRIFT'
  WHEN kind = 'categorical' AND s >= 5 THEN 'KEEP_DRIFTED'
  WHEN r = 1 AND t >= 6 THEN 'DROP_NOVEL_UNRELIABLE'
  WHEN kind = 'categorical' AND s <= 1 THEN 'DROP_NOVEL_UNRELIABLE'
  ELSE 'KEEP_DRIFTED' END AS action FROM p)
SELECT k, action, CASE WHEN action LIKE 'RE%' THEN 'REPAIR' WHEN action LIKE 'DROP%' THEN 'DROP' ELSE 'KEEP' END AS family,
  CASE action WHEN 'REVERSE_PERCENTILE' THEN 'Reverse percentile representation' WHEN 'REALIGN_SCALE' THEN 'Scale realignment' WHEN 'REALIGN_OFFSET' THEN 'Offset realignment' WHEN 'REMAP_CATEGORIES' THEN 'Category remapping'
    WHEN 'DROP_NOVEL_UNRELIABLE' THEN 'Exclude unreliable feature' WHEN 'KEEP_DRIFTED' THEN 'Preserve same-semantic population drift' WHEN 'KEEP_SYSTEMIC_DRIFT' THEN 'Preserve systemic drift' ELSE 'No mitigation applied' END AS method FROM a""")
def policy_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every branch of the policy over evidence rows made from part keys."""
    k = F.col("p_partkey")
    r, q, s, t = k % 3, F.floor(k / 6) % 5, k % 7, k % 11
    numeric = k % 2 == 0
    checks = F.struct((q == 2).alias("scale_repair_safe"), (q == 3).alias("offset_repair_safe"), (q == 4).alias("category_remap_safe"))
    turned = (s == 1) & (q == 1)
    evidence = table(spark, sf_dir, "part").select(
        k.alias("k"), F.when(numeric, F.lit("numeric")).otherwise(F.lit("categorical")).alias("kind"),
        F.when(r == 0, F.lit("REVIEW_NOVEL")).when(r == 1, F.lit("REVIEW_MISSINGNESS")).otherwise(F.lit("KEEP")).alias("action"),
        F.lit(50).alias("unique_values"), F.lit(9).alias("orientation_anchor_count"), F.lit(0.4).alias("orientation_train"), F.when(turned, F.lit(-0.3)).otherwise(F.lit(0.3)).alias("orientation_test"),
        F.lit(3.0).alias("novelty_ratio"), F.lit(0.5).alias("predictive_strength"), F.lit(0.9).alias("support_retention_ratio"),
        F.when(q == 2, F.lit(100.0)).alias("scale_factor"), F.when(q == 3, F.lit(5.0)).alias("offset"), F.when(q == 4, F.create_map(F.lit("x"), F.lit("y"))).alias("category_mapping"),
        checks.alias("evidence_checks"), (t == 0).alias("systemic_drift_active"), F.when(s >= 5, F.lit(0.9)).when(s <= 1, F.lit(0.1)).otherwise(F.lit(0.5)).alias("known_category_support_ratio"),
        F.when(t >= 6, F.lit(0.6)).otherwise(F.lit(0.2)).alias("missing_shift"),
    )
    out = policy.choose_actions(evidence)
    return out.select("k", "action", policy.family(F.col("action")).alias("family"), policy.method(F.col("action")).alias("method"))


# ---------------------------------------------------------------- plan and transform


@query(f"""WITH {ORDERS_SQL} SELECT feature, level, CAST(row_number() OVER (PARTITION BY feature ORDER BY level) - 1 AS INTEGER) AS code FROM (
  SELECT DISTINCT 'o_orderpriority' AS feature, lower(trim(o_orderpriority)) AS level FROM f WHERE NOT now UNION ALL SELECT DISTINCT 'n_name', lower(trim(n_name)) FROM f WHERE NOT now)""")
def category_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preparation.category_codes(sides(orders_frame(spark, sf_dir))[0], ["o_orderpriority", "n_name"])


@query(f"WITH {ORDERS_SQL}, {long_sql(ORDER_NUMBERS, NULLED)} SELECT feature, round(median(v), 6) AS fill FROM l WHERE NOT now GROUP BY feature")
def fill_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(preparation.fill_values(sides(nulled(orders_frame(spark, sf_dir), ORDER_NUMBERS))[0], ORDER_NUMBERS))


KNOTS = "rank() OVER (PARTITION BY {k} ORDER BY o_totalprice) + (count(*) OVER (PARTITION BY {k2} o_totalprice) - 1) / 2.0"


@query(f"""WITH {ORDERS_SQL}, k AS (SELECT DISTINCT '__all__' AS period, o_totalprice AS value, (rank() OVER (ORDER BY o_totalprice) + (count(*) OVER (PARTITION BY o_totalprice) - 1) / 2.0) / count(*) OVER () AS pct FROM f WHERE NOT now),
m AS (SELECT *, row_number() OVER (ORDER BY value) - 1 AS pos, count(*) OVER () AS n FROM k), s AS (SELECT DISTINCT CAST(round_even(i * (n - 1) / 511.0, 0) AS BIGINT) AS pos FROM range(0, 512) AS r(i), (SELECT max(n) AS n FROM m))
SELECT 'o_totalprice' AS feature, period, CAST(pos AS INTEGER) AS position, round(value, 6) AS value, round(pct, 6) AS percentile FROM m WHERE n <= 512 OR pos IN (SELECT pos FROM s)""")
def rank_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Knots of the pooled map, thinned to 512."""
    one = ranks.rank_map_knots(sides(orders_frame(spark, sf_dir))[0], ["o_totalprice"], most=512)
    return rounded(one.where(F.col("period") == C.POOLED))


@query(f"""WITH {ORDERS_SQL}, k AS (SELECT DISTINCT p, o_totalprice AS value, (rank() OVER (PARTITION BY p ORDER BY o_totalprice) + (count(*) OVER (PARTITION BY p, o_totalprice) - 1) / 2.0) / count(*) OVER (PARTITION BY p) AS pct FROM f WHERE now)
SELECT 'o_totalprice' AS feature, CAST(p AS VARCHAR) AS period, CAST(pos AS INTEGER) AS position, round(value, 6) AS value, round(pct, 6) AS percentile
FROM (SELECT *, row_number() OVER (PARTITION BY p ORDER BY value) - 1 AS pos, count(*) OVER (PARTITION BY p) AS n FROM k) WHERE n <= 8192 OR pos IN (SELECT CAST(round_even(i * (n - 1) / 8191.0, 0) AS BIGINT) FROM range(0, 8192) AS r(i))""")
def rank_map_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = ranks.rank_map_knots(sides(orders_frame(spark, sf_dir))[1], ["o_totalprice"])
    return rounded(one.where(F.col("period") != C.POOLED))


@query(f"""WITH {ORDERS_SQL}, r AS (SELECT id, p, CASE WHEN id % 9 = 0 OR (now AND (id * 13) % 10 < 7) THEN NULL ELSE o_totalprice END AS v FROM f)
SELECT id, round(CASE WHEN v IS NOT NULL THEN (rank() OVER (PARTITION BY p ORDER BY v NULLS LAST) + (count(*) OVER (PARTITION BY p, v) - 1) / 2.0) / count(v) OVER (PARTITION BY p) END, 6) AS percentile FROM r""")
def pct_rank_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = nulled(orders_frame(spark, sf_dir), ["o_totalprice"])
    return rounded(ranks.with_percentile(frame.select("id", "period_idx", "o_totalprice"), "period_idx", "o_totalprice", "percentile").select("id", "percentile"))


def _fixed_plan(**more) -> preparation.PreparationPlan:
    """A frozen plan with hand-set parameters, so that SQL can say the same."""
    empty = dict(features=[], numeric=[], categorical=[], dropped=[], ranked=[], reversed=[], codes={}, fills={}, scales={}, offsets={}, remaps={}, evidence=[], thresholds={})
    return preparation.PreparationPlan(ColumnContract("id", "period_idx", "target"), **(empty | more))


@query(f"WITH {ORDERS_SQL} SELECT id, round(CAST(coalesce(CASE WHEN id % 9 <> 0 AND (id * 13) % 10 >= 7 THEN o_totalprice END / 100.0, 7.5) AS FLOAT), 3) AS o_totalprice FROM f WHERE now")
def transform_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = sides(nulled(orders_frame(spark, sf_dir), ["o_totalprice"]))[1]
    plan = _fixed_plan(features=["o_totalprice"], numeric=["o_totalprice"], fills={"o_totalprice": 7.5}, scales={"o_totalprice": 100.0})
    return preparation.transform(current, plan, "test", ("id",)).withColumn("o_totalprice", F.round("o_totalprice", 3))


@query(f"WITH {ORDERS_SQL} SELECT id, round(CAST(coalesce(c_acctbal - 1000.25, 7.5) AS FLOAT), 3) AS c_acctbal FROM f WHERE now")
def transform_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = _fixed_plan(features=["c_acctbal"], numeric=["c_acctbal"], fills={"c_acctbal": 7.5}, offsets={"c_acctbal": 1000.25})
    return preparation.transform(sides(orders_frame(spark, sf_dir))[1], plan, "test", ("id",)).withColumn("c_acctbal", F.round("c_acctbal", 3))


@query(f"WITH {ORDERS_SQL} SELECT id, CAST(CASE WHEN id % 10 < 6 THEN 0 WHEN id % 10 < 9 THEN 1 ELSE -1 END AS INTEGER) AS tier FROM f WHERE now")
def transform_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = _fixed_plan(features=["tier"], categorical=["tier"], codes={"tier": {"a": 0, "b": 1}}, remaps={"tier": {"new_a": "a", "new_b": "b", "new_c": "c"}})
    return preparation.transform(sides(tiers(orders_frame(spark, sf_dir)))[1], plan, "test", ("id",))


@query(f"""WITH {ORDERS_SQL}, k AS (SELECT id, (rank() OVER (PARTITION BY p ORDER BY o_totalprice) + (count(*) OVER (PARTITION BY p, o_totalprice) - 1) / 2.0) / count(*) OVER (PARTITION BY p) AS pct FROM f WHERE now)
SELECT id, round(CAST(1.0 AS FLOAT) - CAST(pct AS FLOAT), 4) AS o_totalprice FROM k""")
def transform_reverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of the row's own period, reversed.  The maps have every knot, so they give the ranks themselves; they stay a table."""
    current = sides(orders_frame(spark, sf_dir))[1]
    plan = _fixed_plan(features=["o_totalprice"], numeric=["o_totalprice"], fills={"o_totalprice": 0.5}, ranked=["o_totalprice"], reversed=["o_totalprice"])
    maps = ranks.whole_maps(current, ["o_totalprice"])
    return preparation.transform(current, plan, "test", ("id",), maps).withColumn("o_totalprice", F.round("o_totalprice", 4))


@query()
def transform_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plan of the injected frame, applied to its current side (rows only)."""
    train, current = sides(tiers(scaled_orders(spark, sf_dir)))
    plan = preparation.build_plan(train, current, ColumnContract("id", "period_idx", "target"))
    return preparation.transform(current, plan, "test", ("id",))


# ---------------------------------------------------------------- samples


@query("""SELECT o_orderkey, o_custkey FROM orders ORDER BY md5('21|' || o_orderkey || '|' || o_custkey), o_orderkey, o_custkey LIMIT 500""")
def bottomk_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.bottom_k(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey", "o_custkey"], 500)


@query("""WITH m AS (SELECT o_orderkey FROM orders ORDER BY md5('21|' || o_orderkey), o_orderkey LIMIT 800) SELECT o_orderkey FROM m ORDER BY md5('22|' || o_orderkey), o_orderkey LIMIT 300""")
def nested_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.nested_samples(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 800, 300)[1]


@query(f"""WITH {ORDERS_SQL} SELECT p AS period_idx, y AS target, id FROM (SELECT p, y, id, row_number() OVER (PARTITION BY p, y ORDER BY md5('21|' || id), id) AS k FROM f WHERE NOT now) WHERE k <= 80""")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = sides(orders_frame(spark, sf_dir))[0].select("period_idx", "target", "id")
    return sampling.per_stratum(train, ["period_idx", "target"], ["id"], 80)


@query("""SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS row_ordinal FROM orders""")
def row_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.with_ordinal(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"]).select("o_orderkey", "row_ordinal")


# ---------------------------------------------------------------- report tables


@query(f"""WITH {LINES_SQL}, {long_sql(["l_extendedprice", "l_quantity"])}, w AS (SELECT feature, v, now FROM l WHERE side >= 0), e AS (SELECT feature, min(v) AS lo, max(v) AS hi FROM w GROUP BY feature),
b AS (SELECT e.feature, i, CASE WHEN i = 20 THEN hi ELSE lo + i * ((hi - lo) / 20) END AS x FROM e, range(0, 21) AS r(i))
SELECT w.feature, now, CAST(least((SELECT count(*) FROM b WHERE b.feature = w.feature AND b.x <= w.v), 20) - 1 AS INTEGER) AS bin, count(*) AS n FROM w GROUP BY ALL""")
def hist_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = lines_frame(spark, sf_dir)
    train, _ = sides(frame)
    blocks = profile.history_blocks(train)
    recent = frame.where(F.col("now") | F.col("period_idx").isin(*blocks.members(blocks.count - 1)))
    long = profile.long_form(recent, ["now"], ["l_extendedprice", "l_quantity"], True)
    return report.histograms(long, report.shared_edges(long), ["now"])


@query("""WITH l AS (SELECT lower(trim(p_type)) AS level, p_size > 25 AS big FROM part), c AS (SELECT level, count(*) FILTER (NOT big) AS n_small, count(*) FILTER (big) AS n_large FROM l GROUP BY level),
r AS (SELECT *, row_number() OVER (ORDER BY n_small + n_large DESC, level) AS r, count(*) OVER () AS m FROM c),
k AS (SELECT CASE WHEN r <= CASE WHEN m > 25 THEN 24 ELSE 25 END THEN level ELSE 'Other' END AS category, least(r, CASE WHEN m > 25 THEN 25 ELSE 26 END) AS position, n_small, n_large FROM r)
SELECT 'p_type' AS feature, category, CAST(position AS INTEGER) AS position, CAST(sum(n_small) AS BIGINT) AS n_small, CAST(sum(n_large) AS BIGINT) AS n_large,
  round(sum(n_small) / greatest(1, sum(sum(n_small)) OVER ()), 6) AS share_small, round(sum(n_large) / greatest(1, sum(sum(n_large)) OVER ()), 6) AS share_large FROM k GROUP BY category, position""")
def cat_distribution_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    side = F.when(F.col("p_size") > 25, F.lit("large")).otherwise(F.lit("small"))
    long = table(spark, sf_dir, "part").select(F.lit("p_type").alias("feature"), F.col("p_type").alias("value"), side.alias("side"))
    return rounded(report.category_shares(long, ["small", "large"]))


def _shown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feature list with one row for each part type."""
    kinds = table(spark, sf_dir, "part").groupBy("p_type").agg(F.count("*").alias("n"), F.avg("p_retailprice").alias("m"))
    action = F.when(F.col("n") % 3 == 0, F.lit("KEEP")).when(F.col("n") % 3 == 1, F.lit("REALIGN_SCALE")).otherwise(F.lit("DROP_NOVEL_UNRELIABLE"))
    evidence = kinds.select(
        F.col("p_type").alias("feature"), F.lit("numeric").alias("kind"), action.alias("action"), (F.col("n") / 1000).alias("current_shift"), F.lit(0.01).alias("historical_max_shift"), F.round(F.col("m") / 100, 3).alias("novelty_ratio")
    )
    return report.feature_table(evidence)


SHOWN_SQL = """k AS (SELECT p_type AS feature, count(*) AS n, round(avg(p_retailprice) / 100, 3) AS severity FROM part GROUP BY p_type),
s AS (SELECT feature, 'Numeric' AS type, CASE WHEN n % 3 = 0 THEN 'Stable' ELSE 'Changed' END AS status, n / 1000 AS current, CAST(0.01 AS DOUBLE) AS historical, severity, CASE n % 3 WHEN 0 THEN 'Keep' WHEN 1 THEN 'Repair' ELSE 'Drop' END AS action FROM k)"""


@query(f"WITH {SHOWN_SQL} SELECT feature, type, status, round(current, 6) AS current, historical, severity, action FROM s WHERE lower(feature) LIKE '%m%' AND status = 'Changed'")
def report_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(report.filtered(_shown(spark, sf_dir), search="M", status="Changed"))


@query(f"WITH {SHOWN_SQL} SELECT feature, severity, action FROM s ORDER BY severity DESC, feature LIMIT 10")
def severity_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.most_severe(_shown(spark, sf_dir))


@query(f"WITH {SHOWN_SQL} SELECT action, count(*) AS n, string_agg(feature, ',' ORDER BY feature) AS features FROM s GROUP BY action")
def action_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.action_counts(_shown(spark, sf_dir))


# ---------------------------------------------------------------- scores


@query("""WITH s AS (SELECT l_returnflag AS flag, l_discount + l_tax AS v, CAST(l_quantity > 25 AS INTEGER) AS y FROM lineitem), c AS (SELECT flag, v, count(*) AS n, sum(y) AS p FROM s GROUP BY ALL),
w AS (SELECT flag, p, sum(n) OVER x AS cn, sum(p) OVER x AS cp, sum(p) OVER (PARTITION BY flag) AS t FROM c WINDOW x AS (PARTITION BY flag ORDER BY v DESC))
SELECT flag, round(sum(p / t * cp / cn), 6) AS average_precision FROM w GROUP BY flag""")
def avg_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("flag"), (F.col("l_discount") + F.col("l_tax")).alias("v"), (F.col("l_quantity") > 25).cast("int").alias("y"))
    return rounded(evaluate.average_precision(x, "v", "y", ("flag",)))


@query("""SELECT count(*) AS row_count, count(*) FILTER (o_orderkey % 10 = 0 OR o_orderkey % 10 = 1) AS bad_scores FROM orders""")
def score_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey") % 10
    s = F.when(k == 0, F.lit(1.5)).when(k == 1, F.lit(float("nan"))).otherwise(k / 10)
    return evaluate.score_violations(table(spark, sf_dir, "orders").select(s.alias("probability_score")))


@query("""WITH x AS (SELECT o_orderkey AS k, row_number() OVER (ORDER BY o_orderkey) - 1 AS o FROM orders), n AS (SELECT count(*) AS n FROM x)
SELECT n AS prediction_rows, n AS labelled_rows, (SELECT count(*) FROM x WHERE k % 97 = 0) AS id_mismatches, CAST(0 AS BIGINT) AS null_ids, CAST(0 AS BIGINT) AS bad_scores, (SELECT count(*) FROM x WHERE k % 89 = 0) AS bad_labels,
  (SELECT count(*) FROM (SELECT CASE WHEN k % 97 = 0 THEN k + 1 ELSE k END AS a FROM x GROUP BY a HAVING count(*) > 1)) AS duplicate_ids FROM n""")
def prediction_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = sampling.with_ordinal(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"])
    k = F.col("o_orderkey")
    made = base.select("row_ordinal", F.when(k % 97 == 0, k + 1).otherwise(k).alias("id"), F.lit(0.5).alias("probability_score"))
    labelled = base.select("row_ordinal", k.alias("id"), F.when(k % 89 == 0, F.lit("?")).when(k % 2 == 0, F.lit("Yes")).otherwise(F.lit("0")).alias("target"))
    return evaluate.prediction_contract(made, labelled, "id", "target")


@query()
def gbt_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One fit on the training side with the default number of trees, scores of the current one (rows only: the booster is Spark's)."""
    train, current = sides(orders_frame(spark, sf_dir))
    plan = preparation.build_plan(train, current, ColumnContract("id", "period_idx", "target"))
    model = OnceFitted(plan).fit(train.withColumn("__target", F.col("target")))
    return model.score(current)


@query(f"WITH {ORDERS_SQL} SELECT id, round(CAST(o_totalprice / 100.0 AS FLOAT), 3) AS o_totalprice FROM f WHERE now")
def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frozen plan over a stream of the orders table, one micro-batch a file; the rows of the batch projection."""
    from .streaming.score import is_folder, scratch_folder, transformed_stream

    plan = _fixed_plan(features=["o_totalprice"], numeric=["o_totalprice"], fills={"o_totalprice": 0.0}, scales={"o_totalprice": 100.0})
    schema = table(spark, sf_dir, "orders").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/orders.parquet" if is_folder(spark, f"{sf_dir}/orders.parquet") else f"{sf_dir}/orders.parq[u]et")
    rows = stream.where(F.col("o_orderdate") >= SPLIT).select(F.col("o_orderkey").alias("id"), "o_totalprice")
    out = scratch_folder(spark, "stream-score")
    running = transformed_stream(rows, plan, ()).writeStream.format("parquet").option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start(f"{out}/rows")
    running.awaitTermination()
    return spark.read.parquet(f"{out}/rows").withColumn("o_totalprice", F.round("o_totalprice", 3))
