"""End-to-end compositions: career tables and the graph, from one fact table."""

from __future__ import annotations

import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stintwise.operators import careers, graph, normalise, schema
from stintwise.schemas import CHRONOLOGY_ITEM
from stintwise.session import materialize
from stintwise.sources import csv as csv_io
from stintwise.sources.documents import read_document_maps, read_season_documents
from stintwise.sources.tables import read_fact_table, write_fact_table


def career_tables(a: DataFrame, midseason: bool = False,
                  s: DataFrame | None = None) -> dict[str, DataFrame]:
    """The four tables of the transfer-graph job (SNK-3): one pass over ``a``, spans shared."""
    e = careers.yearly_entries(a)
    s = careers.shared_spans(e) if s is None else s
    transfers = (careers.transfers_with_midseason(a, s) if midseason
                 else careers.transfers_consecutive(a, s))
    return {"debuts": careers.debuts(e, s),
            "retirements": careers.retirements(a, e),
            "transfers": transfers,
            "breaks": careers.breaks(a, midseason, s)}


def career_graph(a: DataFrame, s: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges as the notebook loads them (transfers incl. same season)."""
    s = careers.shared_spans(a) if s is None else s
    edges = graph.span_graph_edges(careers.debuts(a, s), s)
    return graph.graph_nodes(edges), edges


# ----------------------------------------------------------------- ingest
# Folder names of the entity documents and the tables made from them.
SIMPLE_ENTITIES = ["chassis", "continents", "countries", "engine-manufacturers", "engines",
                   "entrants", "grands-prix", "tyre-manufacturers"]
RELATION = T.StructType([T.StructField("driverId", T.StringType()), T.StructField("type", T.StringType())])


def _has_files(spark: SparkSession, pattern: str) -> bool:
    """Whether a path pattern matches files, on any filesystem Spark can read."""
    try:
        spark.read.format("binaryFile").load(pattern).select("path")
        return True
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":     # anything else is a failure, not an absent folder
            raise
        return False


def _entity_table(spark: SparkSession, folder: str, nested: str | None, strict: bool):
    # Parse every document once: key discovery and all table writes read this copy.
    docs = materialize(read_document_maps(spark, f"{folder}/*"), "documents")
    keys = schema.key_list(schema.discover_keys(docs, ["_path", "_doc"]))
    flat = [k for k in keys if k != nested]
    record = schema.project_record(docs, flat, on_missing="error" if strict else "null",
                                   keep=["doc"])
    if nested:
        # The nested list is optional in every document (and may be absent in all).
        record = record.withColumn(nested, F.element_at("doc", F.lit(nested)))
    return docs, record.drop("doc"), flat


def ingest_entities(spark: SparkSession, source_dir: str, out_dir: str,
                    strict: bool = False) -> dict[str, str]:
    """YAML entity folders -> CSV tables (SRC-1, SCH-1..5, NRM-1..5, SNK-1)."""
    out: dict[str, str] = {}
    absent = []

    def present(name: str, pattern: str) -> bool:
        found = _has_files(spark, pattern)
        if not found:
            absent.append(name)
        return found

    def write(name, df):
        path = f"{out_dir.rstrip('/')}/{name}"
        csv_io.write_csv(df, path)
        out[name] = path

    root = source_dir.rstrip("/")
    for name in SIMPLE_ENTITIES:
        folder = f"{root}/{name}"
        if present(folder.rsplit("/", 1)[1], f"{folder}/*"):
            _, rec, flat = _entity_table(spark, folder, None, strict)
            write(name, rec.select(*flat))

    folder = f"{root}/circuits"
    if present(folder.rsplit("/", 1)[1], f"{folder}/*"):
        _, rec, flat = _entity_table(spark, folder, "previousNames", strict)
        write("circuits", schema.drop_nested(rec, "previousNames").select(*flat))
        names = rec.select("id", F.from_json("previousNames", T.ArrayType(T.StringType())).alias("pn"))
        write("previous_circuits_names",
              normalise.explode_child(names, "id", "pn", out_parent="circuitId", item="previousName"))

    folder = f"{root}/drivers"
    if present(folder.rsplit("/", 1)[1], f"{folder}/*"):
        _, rec, flat = _entity_table(spark, folder, "familyRelationships", strict)
        write("drivers", schema.drop_nested(rec, "familyRelationships").select(*flat))
        rel = rec.select("id", F.from_json("familyRelationships", T.ArrayType(RELATION)).alias("fr"))
        write("drivers_relationships",
              normalise.explode_child(rel, "id", "fr", out_parent="driverId",
                                      fields={"relationId": "driverId", "type": "type"}))

    folder = f"{root}/constructors"
    if present(folder.rsplit("/", 1)[1], f"{folder}/*"):
        _, rec, flat = _entity_table(spark, folder, "chronology", strict)
        write("constructors", schema.drop_nested(rec, "chronology").select(*flat))
        chains = rec.select("id", F.from_json("chronology", T.ArrayType(CHRONOLOGY_ITEM)).alias("chain"))
        write("rebranding_history", normalise.rebranding_history(chains, "id", "chain"))

    seasons = f"{root}/seasons"
    if present("seasons", f"{seasons}/*/entrants.yml"):
        apps = read_season_documents(spark, seasons, strict=strict)
        write("driversAllYears", apps.withColumnRenamed("driverId", "driverID"))
    if absent:
        warnings.warn(f"no files, not built: {', '.join(absent)}", stacklevel=2)
    return out


def build_all(spark: SparkSession, source_dir: str, out_dir: str,
              strict: bool = False) -> dict[str, str]:
    """Ingest -> flat tables -> career tables -> graph, all as Spark jobs.

    The appearance table is written as CSV (the ingest output) and as parquet
    partitioned by year; the career relations read the parquet copy, so their
    ``year < latest`` filters prune partitions and scans read only used columns.
    ``strict`` fails the job on a document that lacks a discovered key and on a season
    entry without constructor, driver or ``rounds`` key, as the
    reference does; by default the cell is null.  Datasets whose folder is absent
    are named in a warning.
    """
    out = ingest_entities(spark, source_dir, out_dir, strict=strict)
    if "driversAllYears" in out:
        fact = f"{out_dir.rstrip('/')}/appearances"
        write_fact_table(csv_io.read_appearances(spark, out["driversAllYears"]), fact)
        out["appearances"] = fact
        a = read_fact_table(spark, fact)
        s = careers.shared_spans(a)
        tables = career_tables(a, s=s)
        for name, path in csv_io.write_career_tables(
                tables, f"{out_dir.rstrip('/')}/transferGraph").items():
            out[f"transferGraph/{name}"] = path
        nodes, edges = career_graph(a, s)
        import_nodes, import_edges = graph.import_tables(nodes, edges)
        for name, df in (("nodes", nodes), ("edges", edges), ("import/nodes", import_nodes),
                         ("import/relationships", import_edges)):
            path = f"{out_dir.rstrip('/')}/graph/{name}"
            csv_io.write_csv(df, path)
            out[f"graph/{name}"] = path
    return out
