"""Registry of named queries over the test tables, each with a DuckDB oracle.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``ORACLE[name]`` is the
same relation in SQL over the pre-registered parquet views.  Column names
match between the two.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from stintwise.operators import careers, graph, graph_store, normalise, schema
from stintwise.plans.build import career_tables
from stintwise.plans.views import register_career_views
from stintwise.session import materialize, scratch_path
from stintwise.sources import csv as csv_io
from stintwise.sources import documents
from stintwise.sources import nested_bindings as nb
from stintwise.sources.bindings import APPEARANCES_SQL, appearances, table
from stintwise.sources.tables import read_fact_table, write_fact_table
from stintwise.streaming import career_stream, read_career_state, season_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def with_appearances(body: str) -> str:
    return f"WITH appearances AS ({APPEARANCES_SQL}),\n{body}"


# ---------------------------------------------------------------- SQL pieces
# The oracle is an independent formulation: one span table, arithmetic on its
# ends, NOT EXISTS for the anti-join, MIN() OVER for the arg-min steps.
_SP = """sp AS (
  SELECT driverId, constructorId, MIN(year) AS first_year, MAX(year) AS last_year
  FROM appearances WHERE tookPart GROUP BY driverId, constructorId)"""
_FIRST = """first_seen AS (
  SELECT driverId, MIN(year) AS debut_year FROM appearances WHERE tookPart GROUP BY driverId)"""
_LAST = """last_seen AS (
  SELECT driverId, MAX(year) AS retirement_year FROM appearances WHERE tookPart GROUP BY driverId
  HAVING MAX(year) < (SELECT MAX(year) FROM appearances))"""
_TNEXT = """t_next AS (
  SELECT p.driverId, p.constructorId AS const_out, p.last_year AS transfer_out,
         q.constructorId AS const_in, q.first_year AS transfer_in
  FROM sp p JOIN sp q ON q.driverId = p.driverId AND q.first_year = p.last_year + 1)"""
_TANY = """t_any AS (
  SELECT p.driverId, p.constructorId AS const_out, p.last_year AS transfer_out,
         q.constructorId AS const_in, q.first_year AS transfer_in
  FROM sp p JOIN sp q ON q.driverId = p.driverId AND q.constructorId <> p.constructorId
                     AND q.first_year IN (p.last_year, p.last_year + 1))"""
_GAPS = """gaps AS (
  SELECT DISTINCT p.driverId, p.constructorId AS const_out, p.last_year AS break_year,
         q.constructorId AS const_in, q.first_year AS return_year,
         q.first_year - p.last_year AS gap
  FROM sp p JOIN sp q ON q.driverId = p.driverId AND q.first_year - p.last_year >= 2)"""


def _unexplained(transfers: str) -> str:
    return f"""unexplained AS (
  SELECT g.* FROM gaps g
  WHERE NOT EXISTS (SELECT 1 FROM {transfers} x
                    WHERE x.driverId = g.driverId AND x.const_in = g.const_in
                      AND x.transfer_in = g.return_year))"""


_NEAR = """near AS (
  SELECT driverId, const_out, break_year, const_in, return_year, gap FROM (
    SELECT u.*, MIN(gap) OVER (PARTITION BY driverId, const_in, return_year) AS best
    FROM unexplained u WHERE const_in IS NOT NULL) w
  WHERE gap = best)"""
_BRK = """brk AS (
  SELECT driverId, const_out, break_year, const_in, return_year, gap FROM (
    SELECT n.*, MIN(gap) OVER (PARTITION BY driverId, const_out, break_year) AS best
    FROM near n WHERE const_out IS NOT NULL) w
  WHERE gap = best)"""


def _breaks_sql(transfers: str, final: str) -> str:
    tdef = _TNEXT if transfers == "t_next" else _TANY
    return with_appearances(",\n".join([_SP, tdef, _GAPS, _unexplained(transfers), _NEAR, _BRK])
                            + f"\nSELECT * FROM {final}")


# ---------------------------------------------------------------- career queries
@register("appearances", "SELECT * FROM (" + APPEARANCES_SQL + ") t")
def q_appearances(spark, sf):
    return appearances(spark, sf)


@register("spans", with_appearances(_SP + "\nSELECT * FROM sp"))
def q_spans(spark, sf):
    return careers.spans(appearances(spark, sf))


@register("debut_years", with_appearances(_FIRST + "\nSELECT debut_year, driverId FROM first_seen"))
def q_debut_years(spark, sf):
    return careers.debut_years(appearances(spark, sf))


_DEBUT_ROWS = """
SELECT x.driverId, x.constructorId, f.debut_year
FROM appearances x JOIN first_seen f USING (driverId)
WHERE x.year = f.debut_year"""


@register("debuts", with_appearances(_FIRST + _DEBUT_ROWS))
def q_debuts(spark, sf):
    return careers.debuts(appearances(spark, sf))


@register("last_seen_before_max", with_appearances(
    _LAST + "\nSELECT retirement_year, driverId FROM last_seen"))
def q_last_seen(spark, sf):
    return careers.last_seen_before_max(appearances(spark, sf))


_RETIREMENT_ROWS = """
SELECT x.driverId, x.constructorId, l.retirement_year
FROM appearances x JOIN last_seen l USING (driverId)
WHERE x.year = l.retirement_year"""


@register("retirements", with_appearances(_LAST + _RETIREMENT_ROWS))
def q_retirements(spark, sf):
    return careers.retirements(appearances(spark, sf))


_ANNOUNCED = """latest AS (SELECT MAX(year) AS y FROM appearances),
before_latest AS (SELECT * FROM appearances WHERE year < (SELECT y FROM latest)),
previous AS (SELECT MAX(year) AS y FROM before_latest),
active_before AS (SELECT driverId, constructorId, year FROM before_latest WHERE tookPart),
last_active AS (SELECT driverId, MAX(year) AS y FROM active_before GROUP BY driverId),
candidates AS (
  SELECT b.driverId, b.constructorId, b.year AS retirement_year
  FROM active_before b JOIN last_active l ON l.driverId = b.driverId AND l.y = b.year),
listed AS (SELECT driverId FROM appearances
           WHERE year = (SELECT y FROM latest) AND tookPart = FALSE),
announced AS (
  SELECT * FROM candidates
  WHERE retirement_year < (SELECT y FROM previous)
     OR driverId NOT IN (SELECT driverId FROM listed))"""


@register("retirements_announced", with_appearances(_ANNOUNCED + "\nSELECT * FROM announced"))
def q_retirements_announced(spark, sf):
    return careers.retirements_announced(appearances(spark, sf))


@register("retirements_top", with_appearances(
    _ANNOUNCED + "\nSELECT * FROM announced ORDER BY retirement_year, driverId, constructorId LIMIT 1500"))
def q_retirements_top(spark, sf):
    return careers.retirements_top(appearances(spark, sf), 1500)


@register("second_latest_year", f"""WITH appearances AS ({APPEARANCES_SQL})
SELECT MAX(year) AS second_latest_year FROM appearances
WHERE year < (SELECT MAX(year) FROM appearances)""")
def q_second_latest(spark, sf):
    a = appearances(spark, sf)
    return careers.second_latest_year(materialize(a.select("year").distinct(), "years"))


@register("not_in_announced", with_appearances("""d AS (SELECT DISTINCT driverId FROM appearances)
SELECT driverId FROM d
WHERE driverId NOT IN (SELECT driverId FROM appearances
                       WHERE year = (SELECT MAX(year) FROM appearances) AND tookPart = FALSE)"""))
def q_not_in_announced(spark, sf):
    e = careers.yearly_entries(appearances(spark, sf))      # the one pass over the facts
    return careers.filter_not_in(e.select("driverId").distinct(), "driverId",
                                 careers.announced_only(e), "driverId")


# The list once as it is (with nulls, so nothing is kept), once without nulls (null keys go),
# once empty (everything stays, null keys too).
_NOT_IN_CASES = """keyed AS (SELECT DISTINCT CASE WHEN testDriver AND year % 2 = 0 THEN NULL ELSE driverId END AS driverId
                          FROM appearances),
listed AS (SELECT CASE WHEN testDriver THEN NULL ELSE driverId END AS driverId FROM appearances
           WHERE year = (SELECT MAX(year) FROM appearances) AND tookPart = FALSE)
SELECT 'nulls' AS list_kind, driverId FROM keyed WHERE driverId NOT IN (SELECT driverId FROM listed)
UNION ALL
SELECT 'no nulls', driverId FROM keyed
WHERE driverId NOT IN (SELECT driverId FROM listed WHERE driverId IS NOT NULL)
UNION ALL
SELECT 'empty', driverId FROM keyed WHERE driverId NOT IN (SELECT driverId FROM listed WHERE driverId = '')"""


@register("not_in_null_aware", with_appearances(_NOT_IN_CASES))
def q_not_in_null_aware(spark, sf):
    a = appearances(spark, sf).select("driverId", "year", "tookPart", "testDriver").distinct()
    a = materialize(a, "not-in-facts")                       # the one pass over the facts
    null_if = lambda c: F.when(c, F.lit(None)).otherwise(F.col("driverId")).alias("driverId")
    keyed = a.select(null_if(F.col("testDriver") & (F.col("year") % 2 == 0))).distinct()
    listed = careers.announced_only(a.withColumn("driverId", null_if(F.col("testDriver"))))
    cases = {"nulls": listed, "no nulls": listed.where("driverId IS NOT NULL"), "empty": listed.where("driverId = ''")}
    parts = [careers.filter_not_in(keyed, "driverId", values, "driverId")
             .select(F.lit(kind).alias("list_kind"), "driverId") for kind, values in cases.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("transfers_consecutive", with_appearances(",\n".join([_SP, _TNEXT]) + "\nSELECT * FROM t_next"))
def q_transfers_consecutive(spark, sf):
    a = appearances(spark, sf)
    return careers.transfers_consecutive(a, careers.shared_spans(a))


@register("transfers_with_midseason", with_appearances(",\n".join([_SP, _TANY]) + "\nSELECT * FROM t_any"))
def q_transfers_midseason(spark, sf):
    a = appearances(spark, sf)
    return careers.transfers_with_midseason(a, careers.shared_spans(a))


@register("transfers_of_driver", with_appearances(
    ",\n".join([_SP, _TANY]) + "\nSELECT * FROM t_any WHERE driverId = '1'"))
def q_transfers_of_driver(spark, sf):
    return careers.transfers_of_driver(appearances(spark, sf, driver_id="1"), "1")


@register("gap_pairs", with_appearances(",\n".join([_SP, _GAPS]) + "\nSELECT * FROM gaps"))
def q_gap_pairs(spark, sf):
    a = appearances(spark, sf)
    return careers.gap_pairs(a, careers.shared_spans(a))


@register("gaps_unexplained", _breaks_sql("t_next", "unexplained"))
def q_gaps_unexplained(spark, sf):
    a = appearances(spark, sf)
    return careers.gaps_unexplained(a, False, careers.shared_spans(a))


@register("breaks_nearest_return", _breaks_sql("t_next", "near"))
def q_breaks_nearest(spark, sf):
    a = appearances(spark, sf)
    return careers.breaks_nearest_return(a, False, careers.shared_spans(a))


@register("breaks", _breaks_sql("t_next", "brk"))
def q_breaks(spark, sf):
    a = appearances(spark, sf)
    return careers.breaks(a, False, careers.shared_spans(a))


@register("gaps_unexplained_midseason", _breaks_sql("t_any", "unexplained"))
def q_gaps_unexplained7(spark, sf):
    a = appearances(spark, sf)
    return careers.gaps_unexplained(a, True, careers.shared_spans(a))


@register("breaks_nearest_return_midseason", _breaks_sql("t_any", "near"))
def q_breaks_nearest7(spark, sf):
    a = appearances(spark, sf)
    return careers.breaks_nearest_return(a, True, careers.shared_spans(a))


@register("breaks_midseason", _breaks_sql("t_any", "brk"))
def q_breaks7(spark, sf):
    a = appearances(spark, sf)
    return careers.breaks(a, True, careers.shared_spans(a))


# ---------------------------------------------------------------- normalisation


_LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


# (l_orderkey, l_linenumber) repeats; the other columns tell the ties apart.
@register("dense_id", f"""
SELECT row_number() OVER (ORDER BY {", ".join(_LINE_COLUMNS)}) - 1 AS id, {", ".join(_LINE_COLUMNS)}
FROM lineitem""")
def q_dense_id(spark, sf):
    li = table(spark, sf, "lineitem").select(*_LINE_COLUMNS)
    return normalise.with_dense_id(li, ["l_orderkey", "l_linenumber"])


@register("child_scalar", """
SELECT row_number() OVER (ORDER BY partkey, pos) - 1 AS id, partkey, name
FROM (SELECT p_partkey AS partkey, unnest(string_split(p_name, ' ')) AS name,
             generate_subscripts(string_split(p_name, ' '), 1) AS pos
      FROM part WHERE p_size >= 10) t""")
def q_child_scalar(spark, sf):
    return normalise.explode_child(nb.part_documents(spark, sf), "p_partkey", "names",
                                   out_parent="partkey", item="name")


@register("normalise_parent", """
SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part""")
def q_normalise_parent(spark, sf):
    return schema.drop_nested(nb.part_documents(spark, sf), "names")


@register("child_struct", """
SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS id, conv_id, role, text
FROM conversations""")
def q_child_struct(spark, sf):
    return normalise.explode_child(nb.conversation_documents(spark, sf), "conv_id", "turns",
                                   out_parent="conv_id", fields={"role": "role", "text": "text"})


@register("chain_edges", """
SELECT conv_id, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS roleFrom,
       role AS roleTo, turn
FROM conversations""")
def q_chain_edges(spark, sf):
    return (normalise.chain_edges(nb.conversation_documents(spark, sf), "turns", "role", ["turn"],
                                  from_col="roleFrom", to_col="roleTo", keep=["conv_id"])
            .select("conv_id", "roleFrom", "roleTo", "turn"))


_CHAINS = """
WITH li AS (
  SELECT l_orderkey, l_linenumber, CAST(l_suppkey AS VARCHAR) AS c,
         CAST(year(l_shipdate) AS INTEGER) AS yf,
         CASE WHEN l_linestatus <> 'O' THEN CAST(year(l_shipdate) AS INTEGER) END AS yt
  FROM lineitem),
chains AS (
  SELECT l_orderkey, min(l_orderkey * 10 + l_linenumber) AS owner,
         list(struct_pack(c := c, yf := yf, yt := yt)
              ORDER BY l_linenumber, c, yf NULLS FIRST, yt NULLS FIRST) AS chain
  FROM li GROUP BY l_orderkey),
uniq AS (SELECT chain, min(owner) AS chain_id FROM chains GROUP BY chain),
items AS (SELECT chain_id, unnest(chain) AS e, generate_subscripts(chain, 1) - 1 AS pos FROM uniq)"""


@register("chain_dedupe", _CHAINS + """
SELECT chain_id, lag(e.c) OVER (PARTITION BY chain_id ORDER BY pos) AS constructorIdFrom,
       e.c AS constructorIdTo, e.yf AS yearFrom, e.yt AS yearTo, pos
FROM items""")
def q_chain_dedupe(spark, sf):
    chains = normalise.dedupe_chains(nb.order_chains(spark, sf), "owner", "chain")
    return (normalise.chain_edges(chains, "chain", "constructorId", ["yearFrom", "yearTo"],
                                  from_col="constructorIdFrom", to_col="constructorIdTo",
                                  keep=["chain_id"])
            .withColumnRenamed("_pos", "pos"))


@register("rebranding_history", _CHAINS + """
SELECT lag(e.c) OVER (PARTITION BY chain_id ORDER BY pos) AS "constructorIdFrom",
       e.c AS "constructorIdTo", e.yf AS "yearFrom", e.yt AS "yearTo"
FROM items""")
def q_rebranding_history(spark, sf):
    return normalise.rebranding_history(nb.order_chains(spark, sf), "owner", "chain")


@register("flatten_entries", nb.SEASON_FLAT_SQL)
def q_flatten_entries(spark, sf):
    return normalise.flatten_entries(nb.season_entries(spark, sf))


# ---------------------------------------------------------------- schema discovery
_PART_KEYS = """k AS (
  SELECT p_partkey AS d, list_filter(['p_partkey', 'p_name', 'p_brand',
           CASE WHEN NOT (p_brand LIKE 'Brand#1%') THEN 'p_type' END,
           CASE WHEN p_size >= 25 THEN 'p_size' END, 'p_retailprice'], lambda x: x IS NOT NULL) AS ks
  FROM part),
kp AS (SELECT d, unnest(ks) AS key, generate_subscripts(ks, 1) - 1 AS pos FROM k)"""


@register("discover_keys", f"""WITH {_PART_KEYS},
f AS (SELECT key, min(d * 1000 + pos) AS first FROM kp GROUP BY key)
SELECT key, row_number() OVER (ORDER BY first) - 1 AS ordinal FROM f""")
def q_discover_keys(spark, sf):
    return schema.discover_keys(nb.part_key_maps(spark, sf), ["_doc"])


@register("widest_keys", f"""WITH {_PART_KEYS},
w AS (SELECT ks FROM k ORDER BY len(ks) DESC, d DESC LIMIT 1)
SELECT unnest(ks) AS key, generate_subscripts(ks, 1) - 1 AS ordinal FROM w""")
def q_widest_keys(spark, sf):
    return schema.widest_keys(nb.part_key_maps(spark, sf), ["_doc"])


@register("project_record", """
SELECT p_partkey, p_name, p_brand, CASE WHEN NOT (p_brand LIKE 'Brand#1%') THEN p_type END AS p_type,
       CASE WHEN p_size >= 25 THEN p_size END AS p_size, p_retailprice
FROM part""")
def q_project_record(spark, sf):
    docs = nb.part_key_maps(spark, sf)
    keys = schema.key_list(schema.discover_keys(docs, ["_doc"]))
    rec = schema.project_record(docs, keys, on_missing="null")
    types = {"p_partkey": "bigint", "p_size": "int", "p_retailprice": "double"}
    return rec.select(*[F.col(k).cast(types.get(k, "string")).alias(k) for k in keys])


@register("missing_keys", """
SELECT p_partkey AS _doc, 'p_type' AS key FROM part WHERE p_brand LIKE 'Brand#1%'
UNION ALL
SELECT p_partkey AS _doc, 'p_size' AS key FROM part WHERE p_size < 25""")
def q_missing_keys(spark, sf):
    docs = nb.part_key_maps(spark, sf)
    keys = schema.key_list(schema.discover_keys(docs, ["_doc"]))
    return schema.missing_keys(docs, keys, "_doc")


@register("case_select", """
SELECT s_suppkey AS S_SUPPKEY, s_name AS S_Name, s_nationkey AS s_NationKey, s_acctbal
FROM supplier""")
def q_case_select(spark, sf):
    return schema.case_select(table(spark, sf, "supplier"),
                              ["S_SUPPKEY", "S_Name", "s_NationKey", "s_acctbal"])


# ---------------------------------------------------------------- sources / sinks
_SUPPLIER_SCHEMA = T.StructType([
    T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType()),
    T.StructField("s_nationkey", T.IntegerType()), T.StructField("s_acctbal", T.DoubleType())])


@register("csv_roundtrip", "SELECT * FROM supplier")
def q_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv-supplier")
    csv_io.write_csv(table(spark, sf, "supplier"), path)
    return csv_io.read_csv(spark, path, _SUPPLIER_SCHEMA)


@register("appearances_csv", "SELECT * FROM (" + APPEARANCES_SQL + ") t")
def q_appearances_csv(spark, sf):
    path = scratch_path(spark, "csv-appearances")
    csv_io.write_csv(appearances(spark, sf).withColumnRenamed("driverId", "driverID"), path)
    return csv_io.read_appearances(spark, path)


@register("career_tables", with_appearances(",\n".join([
    _FIRST, _LAST, _SP, _TNEXT, _GAPS, _unexplained("t_next"), _NEAR, _BRK]) + """
SELECT 'debuts' AS table_name, x.driverId, x.constructorId AS const_a, f.debut_year AS year_a,
       CAST(NULL AS VARCHAR) AS const_b, CAST(NULL AS INTEGER) AS year_b
  FROM appearances x JOIN first_seen f USING (driverId) WHERE x.year = f.debut_year
UNION ALL SELECT 'retirements', x.driverId, x.constructorId, l.retirement_year, NULL, NULL
  FROM appearances x JOIN last_seen l USING (driverId) WHERE x.year = l.retirement_year
UNION ALL SELECT 'transfers', driverId, const_out, transfer_out, const_in, transfer_in FROM t_next
UNION ALL SELECT 'breaks', driverId, const_out, break_year, const_in, return_year FROM brk"""))
def q_career_tables(spark, sf):
    """Every row of the four written tables, read back from CSV with the tables' own types."""
    paths = csv_io.write_career_tables(career_tables(appearances(spark, sf)), scratch_path(spark, "career"))
    pair = "driverId string, const_a string, year_a int"
    parts = [csv_io.read_csv(spark, path, pair if name in ("debuts", "retirements")
                             else pair + ", const_b string, year_b int")
             .select(F.lit(name).alias("table_name"), "*") for name, path in paths.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


@register("career_views", with_appearances(",\n".join([
    _SP, _TNEXT, _GAPS, _unexplained("t_next"), _NEAR, _BRK]) + """
SELECT b.driverId, b.const_out, b.break_year, b.return_year, t.const_in AS next_team, t.transfer_in AS next_year
FROM brk b LEFT JOIN t_next t ON t.driverId = b.driverId AND t.transfer_out = b.return_year
WHERE b.gap > 2"""))
def q_career_views(spark, sf):
    """SRC-5: the relations as views, one of them replaced by a query over itself, joined in SQL."""
    names = register_career_views(appearances(spark, sf), global_views=False)
    spark.sql(f"SELECT * FROM {names['breaks']} WHERE gap > 2").createOrReplaceTempView(names["breaks"])
    return spark.sql(f"""
        SELECT b.driverId, b.const_out, b.break_year, b.return_year, t.const_in AS next_team, t.transfer_in AS next_year
        FROM {names['breaks']} b
        LEFT JOIN {names['transfers']} t ON t.driverId = b.driverId AND t.transfer_out = b.return_year""")


@register("doc_scan", "SELECT * FROM supplier")
def q_doc_scan(spark, sf):
    path = scratch_path(spark, "yaml-supplier")
    documents.write_yaml(nb.supplier_yaml(spark, sf), path)
    docs = documents.read_documents(spark, path, _SUPPLIER_SCHEMA)
    return docs.drop("_path", "_doc")


_TEXT_SCHEMA = "doc_id bigint, text string"


@register("csv_text_roundtrip", "SELECT doc_id, nullif(text, '') AS text FROM documents")
def q_csv_text_roundtrip(spark, sf):
    path = scratch_path(spark, "csv-text")
    csv_io.write_csv(table(spark, sf, "documents").select("doc_id", "text"), path)
    return csv_io.read_csv(spark, path, _TEXT_SCHEMA)


@register("csv_split_roundtrip", "SELECT doc_id, text FROM documents")
def q_csv_split_roundtrip(spark, sf):
    path = scratch_path(spark, "csv-split")
    csv_io.write_split_csv(table(spark, sf, "documents").select("doc_id", "text"), path)
    return csv_io.read_split_csv(spark, path, _TEXT_SCHEMA)


@register("yaml_text_roundtrip", "SELECT doc_id, text FROM documents")
def q_yaml_text_roundtrip(spark, sf):
    path = scratch_path(spark, "yaml-text")
    fields = {"doc_id": F.col("doc_id").cast("string"), "text": documents.yaml_quote(F.col("text"))}
    documents.write_yaml(documents.yaml_map_document(table(spark, sf, "documents"), fields), path)
    docs = documents.read_documents(spark, path, T.StructType.fromDDL(_TEXT_SCHEMA))
    return docs.drop("_path", "_doc")


@register("season_scan", nb.SEASON_FLAT_SQL)
def q_season_scan(spark, sf):
    path = scratch_path(spark, "yaml-seasons")
    documents.write_yaml(nb.season_yaml(nb.season_entries(spark, sf)), path, partition_by="year")
    return documents.read_season_documents(spark, path, pattern="*/*.txt")


@register("season_order", "SELECT year, row_number() OVER (ORDER BY year) - 1 AS place FROM (" + nb.SEASON_FLAT_SQL + ") t")
def q_season_order(spark, sf):
    """SRT-1: rows of season files numbered in numeric year order, then by their place in the files."""
    path = scratch_path(spark, "yaml-ordered")
    documents.write_yaml(nb.season_yaml(nb.season_entries(spark, sf)), path, partition_by="year")
    return documents.read_season_documents(spark, path, pattern="*/*.txt", position="place").select("year", "place")


# ---------------------------------------------------------------- graph
_GRAPH_CTES = ",\n".join([_FIRST, _SP, _TANY, _GAPS, _unexplained("t_any"), _NEAR, _BRK]) + """,
debut_rows AS (""" + _DEBUT_ROWS + """),
e_debut AS (SELECT 'Driver' AS src_label, driverId AS src, 'DEBUT' AS type, 'Team' AS dst_label,
                   constructorId AS dst, debut_year AS year FROM debut_rows),
e_transfer AS (SELECT 'Team' AS src_label, const_out AS src, 'TRANSFER_OUT' AS type,
                      'Driver' AS dst_label, driverId AS dst, transfer_out AS year FROM t_any
               UNION ALL
               SELECT 'Driver', driverId, 'TRANSFER_IN', 'Team', const_in, transfer_in FROM t_any),
e_break AS (SELECT 'Team' AS src_label, const_out AS src, 'BREAK' AS type,
                   'Driver' AS dst_label, driverId AS dst, break_year AS year FROM brk
            UNION ALL
            SELECT 'Driver', driverId, 'RETURN', 'Team', const_in, return_year FROM brk),
edges AS (SELECT DISTINCT * FROM (SELECT * FROM e_debut UNION ALL SELECT * FROM e_transfer
                                  UNION ALL SELECT * FROM e_break) u
          WHERE src IS NOT NULL AND dst IS NOT NULL AND year IS NOT NULL)"""


def _graph_inputs(spark, sf):
    """Debuts and spans of the facts, whose joins run once: both read the written columns."""
    a = materialize(appearances(spark, sf).select("driverId", "constructorId", "year", "tookPart"), "facts")
    s = careers.shared_spans(a)
    return careers.debuts(a, s), s


@register("edges_debut", with_appearances(_GRAPH_CTES + "\nSELECT DISTINCT * FROM e_debut"))
def q_edges_debut(spark, sf):
    return graph.edges_debut(careers.debuts(appearances(spark, sf)))


@register("edges_transfer", with_appearances(_GRAPH_CTES + "\nSELECT DISTINCT * FROM e_transfer"))
def q_edges_transfer(spark, sf):
    a = appearances(spark, sf)
    return graph.span_edges_transfer(careers.shared_spans(a))


@register("edges_break", with_appearances(_GRAPH_CTES + "\nSELECT DISTINCT * FROM e_break"))
def q_edges_break(spark, sf):
    a = appearances(spark, sf)
    return graph.span_edges_break(careers.shared_spans(a))


@register("graph_edges", with_appearances(_GRAPH_CTES + "\nSELECT * FROM edges"))
def q_graph_edges(spark, sf):
    return graph.span_graph_edges(*_graph_inputs(spark, sf))


@register("graph_nodes", with_appearances(_GRAPH_CTES + """
SELECT DISTINCT * FROM (SELECT src_label AS label, src AS name FROM edges
                        UNION ALL SELECT dst_label, dst FROM edges) n"""))
def q_graph_nodes(spark, sf):
    return graph.graph_nodes(graph.span_graph_edges(*_graph_inputs(spark, sf)))


@register("graph_merge", with_appearances(_GRAPH_CTES + "\nSELECT * FROM edges"))
def q_graph_merge(spark, sf):
    d, s = _graph_inputs(spark, sf)
    existing = graph.edges_debut(d)
    # the new set is every edge: it repeats all existing rows, which lack transfers and breaks
    new = graph.span_graph_edges(d, s)
    return graph.merge_graph(existing, new, graph.EDGE_COLUMNS)


@register("graph_store_merge", with_appearances(_GRAPH_CTES + """
SELECT e.*, (SELECT count(*) FROM edges) - (SELECT count(DISTINCT (src, dst, year)) FROM e_debut) AS added_second,
       CAST(0 AS BIGINT) AS added_third
FROM edges e"""))
def q_graph_store_merge(spark, sf):
    """Debut edges are stored, all edges merged into them, then all edges once more."""
    d, s = _graph_inputs(spark, sf)
    path = scratch_path(spark, "edge-store")
    edges = materialize(graph.span_graph_edges(d, s), "edges")
    graph_store.merge_edges(path, edges.where(F.col("type") == graph.DEBUT))
    added = [graph_store.merge_edges(path, edges) for _ in range(2)]
    return graph_store.read_edges(spark, path).select(
        "*", F.lit(added[0]).cast("long").alias("added_second"), F.lit(added[1]).cast("long").alias("added_third"))


@register("edges_loaded", with_appearances(_GRAPH_CTES + "\nSELECT * FROM edges"))
def q_edges_loaded(spark, sf):
    """GR-7: every edge reaches a client in batches; a second run finds all of them in the ledger."""
    edges = graph.span_graph_edges(*_graph_inputs(spark, sf))
    batches = materialize(graph.edge_batches(edges, ["type", "src", "dst", "year", "src_label", "dst_label"]), "batches")
    target, ledger = scratch_path(spark, "client"), graph_store.new_ledger(spark)
    graph_store.send_batches_once(batches, graph_store.folder_client(target), ledger)
    again = graph_store.send_batches_once(batches, graph_store.folder_client(target), ledger).count()
    if again:
        raise RuntimeError(f"{again} batches were sent twice")
    return spark.read.schema(edges.schema).json(target)


def _batch_rows(batches):
    return batches.select("batch", F.posexplode("rows").alias("pos", "r")).select(
        "batch", F.col("pos").cast("bigint").alias("pos"), "r.*")


@register("edge_batches", with_appearances(_GRAPH_CTES + """
SELECT rn // 500 AS batch, rn % 500 AS pos, src_label, src, type, dst_label, dst, year FROM (
  SELECT *, row_number() OVER (ORDER BY type, src, dst, year, src_label, dst_label) - 1 AS rn FROM edges) b"""))
def q_edge_batches(spark, sf):
    edges = graph.span_graph_edges(*_graph_inputs(spark, sf))
    return _batch_rows(graph.edge_batches(edges, ["type", "src", "dst", "year", "src_label", "dst_label"]))


@register("transfer_batches", with_appearances(",\n".join([_SP, _TANY]) + """
SELECT rn // 500 AS batch, rn % 500 AS pos, driverId, const_out, transfer_out, const_in, transfer_in FROM (
  SELECT *, row_number() OVER (ORDER BY driverId, transfer_in, const_in, const_out, transfer_out) - 1 AS rn
  FROM t_any) b"""))
def q_transfer_batches(spark, sf):
    """GR-7 for one relation: each row carries the parameters of both edges of a transfer."""
    a = appearances(spark, sf)
    transfers = careers.transfers_with_midseason(a, careers.shared_spans(a))
    return _batch_rows(graph.edge_batches(transfers, ["driverId", "transfer_in", "const_in", "const_out"]))


@register("graph_import_nodes", with_appearances(_GRAPH_CTES + """
SELECT label || ':' || name AS "id:ID", name, label AS ":LABEL" FROM (
  SELECT DISTINCT * FROM (SELECT src_label AS label, src AS name FROM edges
                          UNION ALL SELECT dst_label, dst FROM edges) n) nodes"""))
def q_graph_import_nodes(spark, sf):
    edges = graph.span_graph_edges(*_graph_inputs(spark, sf))
    return graph.import_tables(graph.graph_nodes(edges), edges)[0]


@register("graph_import_relationships", with_appearances(_GRAPH_CTES + """
SELECT src_label || ':' || src AS ":START_ID", dst_label || ':' || dst AS ":END_ID",
       type AS ":TYPE", year AS "year:int" FROM edges"""))
def q_graph_import_relationships(spark, sf):
    edges = graph.span_graph_edges(*_graph_inputs(spark, sf))
    return graph.import_tables(graph.graph_nodes(edges), edges)[1]


@register("season_stream", nb.SEASON_FLAT_SQL)
def q_season_stream(spark, sf):
    src, sink, ckpt = (scratch_path(spark, x) for x in ("stream-src", "stream-sink", "stream-ckpt"))
    documents.write_yaml(nb.season_yaml(nb.season_entries(spark, sf)), src, partition_by="year")
    query = season_stream(spark, src, sink, ckpt, pattern="*/*.txt", available_now=True)
    query.awaitTermination()
    return read_fact_table(spark, sink)


_FLAT_CAREERS = "WITH appearances AS (" + nb.SEASON_FLAT_SQL.strip().rstrip(";") + "),\n"
_CAREER_COLUMNS = "relation string, driverId string, const_a string, year_a int, const_b string, year_b int"


@register("career_stream", _FLAT_CAREERS + ",\n".join([_FIRST, _LAST, _SP, _TNEXT, _TANY, _ANNOUNCED]) + """
SELECT 'debut_years' AS relation, driverId, CAST(NULL AS VARCHAR) AS const_a, debut_year AS year_a,
       CAST(NULL AS VARCHAR) AS const_b, CAST(NULL AS INTEGER) AS year_b FROM first_seen
UNION ALL SELECT 'debuts', x.driverId, x.constructorId, f.debut_year, NULL, NULL
  FROM appearances x JOIN first_seen f USING (driverId) WHERE x.year = f.debut_year
UNION ALL SELECT 'last_seen', driverId, NULL, retirement_year, NULL, NULL FROM last_seen
UNION ALL SELECT 'retirements', x.driverId, x.constructorId, l.retirement_year, NULL, NULL
  FROM appearances x JOIN last_seen l USING (driverId) WHERE x.year = l.retirement_year
UNION ALL SELECT 'announced', driverId, constructorId, retirement_year, NULL, NULL FROM announced
UNION ALL SELECT 'consecutive', driverId, const_out, transfer_out, const_in, transfer_in FROM t_next
UNION ALL SELECT 'midseason', driverId, const_out, transfer_out, const_in, transfer_in FROM t_any""")
def q_career_stream(spark, sf):
    """Q-1 to Q-7 from the state of a stream that takes the season files in several micro-batches."""
    src, state, ckpt = (scratch_path(spark, x) for x in ("career-src", "career-state", "career-ckpt"))
    documents.write_yaml(nb.season_yaml(nb.season_entries(spark, sf)), src, partition_by="year")
    career_stream(spark, src, state, ckpt, pattern="*/*.txt", available_now=True, max_files_per_trigger=4).awaitTermination()
    e = read_career_state(spark, state)
    s = careers.shared_spans(e)
    parts = {"debut_years": careers.debut_years(e).select("driverId", F.lit(None), "debut_year"),
             "debuts": careers.debuts(e, s), "last_seen": careers.last_seen_before_max(e, e).select("driverId", F.lit(None), "retirement_year"),
             "retirements": careers.retirements(e, e), "announced": careers.retirements_announced(e, e),
             "consecutive": careers.transfers_consecutive(e, s), "midseason": careers.transfers_with_midseason(e, s)}
    out = None
    for name, df in parts.items():
        cols = [F.col(f"`{c}`") for c in df.columns] + [F.lit(None)] * (5 - len(df.columns))
        types = [part.split(" ") for part in _CAREER_COLUMNS.split(", ")]
        rows = df.select(*[c.cast(t).alias(n) for c, (n, t) in zip([F.lit(name), *cols], types)])
        out = rows if out is None else out.unionByName(rows)
    return out


@register("fact_table", "SELECT * FROM (" + APPEARANCES_SQL + ") t")
def q_fact_table(spark, sf):
    path = scratch_path(spark, "fact-table")
    write_fact_table(appearances(spark, sf), path)
    return read_fact_table(spark, path)


_NULL_LISTED = """appearances_n AS (
  SELECT year, entrantId, constructorId,
         CASE WHEN testDriver AND year = (SELECT MAX(year) FROM appearances) THEN NULL
              ELSE driverId END AS driverId,
         tookPart, testDriver
  FROM appearances)"""


@register("retirements_null_listed", with_appearances(
    _NULL_LISTED + ",\n" + _ANNOUNCED.replace("FROM appearances", "FROM appearances_n")
    + "\nSELECT * FROM announced"))
def q_retirements_null_listed(spark, sf):
    """Q-5 when the latest season's list holds nulls: NOT IN is never true, the OR still keeps rows."""
    keys = ["driverId", "constructorId", "year", "tookPart"]
    a = appearances(spark, sf).groupBy(*keys, "testDriver").agg(F.count(F.lit(1)).alias(careers.N))
    a = materialize(a, "null-listed")                        # the one pass over the facts
    latest_test = (F.col("year") == careers.latest_year(a)) & F.col("testDriver")
    named = a.withColumn("driverId", F.when(latest_test, F.lit(None)).otherwise(F.col("driverId")))
    e = materialize(named.groupBy(*keys).agg(F.sum(careers.N).alias(careers.N)), "yearly-entries")
    return careers.retirements_announced(e, e)
