"""Folders of YAML entity documents as Spark scans (SRC-1, SRC-2).

Files are read on the executors by Spark's text source with a record delimiter, so one
large file is cut into splits like any other text: a stream of documents at its ``---``
lines, a season at the items of its top-level list.  Each record is parsed once in a
``mapInArrow`` worker (the YAML parser is the only Python on this path) and handed back
as JSON text, which ``from_json`` turns into typed columns with a declared schema.  Records of
the simplest block form (see ``block_reader``) are read line by line, all others by the YAML library.

What cannot be parsed record by record fails with a message that names the file and
``whole=True``, which parses every file in one piece: a list item that uses an anchor of another
item, and a split that begins at a line which only looks like a ``---`` line (``---x``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stintwise.functions.columns import year_from_path
from stintwise.operators.normalise import flatten_entries, with_dense_id
from stintwise.schemas import SEASON_ENTRY
from stintwise.session import materialize

PARSED = "_path string, _doc bigint, _item int, _json string"
YAML_CHUNK_BYTES = 4 << 20  # JSON text per batch handed back to the JVM
PARSE_ROWS = 64             # records that a worker has as Python strings at once
YAML_FILE_DOCS = 2_000      # rows of a written file that is not below a partition folder


# What begins a document of a stream, and an item of a top-level list.
DOCUMENT_MARK, ITEM_MARK = "---", "- "


def document_text(spark: SparkSession, path: str, mark: str | None = None) -> DataFrame:
    """``(_path, _start, _text)``: one row per file, or per record that a line beginning with ``mark`` starts.

    ``_start`` is the byte at which the split begins that a record lies in; the records of a
    split keep their order.
    """
    reader = spark.read if mark is None else spark.read.option("lineSep", "\n" + mark)
    return (reader.text(path, wholetext=mark is None)
            .select(F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start"),
                    F.col("value").alias("_text")))


def block_reader():
    """A function that reads a document of the simplest block form, and gives None for any other text.

    That form: maps and lists of maps, one ``key: value`` a line, a value being a double-quoted
    scalar with JSON's escapes, a short decimal integer, ``true``, ``false`` or nothing, at the
    indents that block style asks for.  On it the result is that of the YAML library, which
    spends most of its time on objects for every token; comments, plain or folded scalars,
    anchors, tags, flow style and whatever else fails to match a line are left to the library.
    """
    import json
    import re

    # Keys that are no strings as plain scalars are left out, as are the surrogates' escapes.
    line_form = re.compile(
        r'^( *)(- )?(?!(?i:yes|no|on|off|true|false|null):)([A-Za-z_][A-Za-z0-9_]{0,63}):'
        r'(?: (0|-?[1-9][0-9]{0,17}|true|false'
        r'|"(?:[^"\\\x00-\x1f\x7f-\x9f\u2028\u2029\ud800-\udfff\ufeff\ufffe\uffff]++'
        r'|\\["\\bfnrt]|\\u(?![dD][89a-fA-F])[0-9a-fA-F]{4})*+")?)? *$', re.MULTILINE)

    flags = {"true", "false"}

    def block(text: str):
        text = text.rstrip("\n")
        if text.startswith("---"):
            first, _, text = text.partition("\n")
            if first.rstrip(" ") != "---":
                return None
        lines = line_form.findall(text)
        if len(lines) != text.count("\n") + 1:
            return None
        root = [] if lines[0][1] else {}
        stack, pending = [(0, root)], None          # (column, list or map); a key without a value yet
        here, node = stack[0]
        if lines[0][0]:
            return None
        for spaces, dash, key, value in lines:
            column = len(spaces)
            if column == here and not dash:
                pass                                # the next key of the same map
            elif pending is not None and column >= here:
                child = [] if dash else {}
                node[pending] = child
                stack.append((column, child))
                here, node = column, child
            else:
                kind = list if dash else dict
                while here > column or here == column and type(node) is not kind:
                    stack.pop()
                    if not stack:
                        return None
                    here, node = stack[-1]
                if here != column:
                    return None
            if dash:
                item = {}
                node.append(item)
                here, node = column + 2, item
                stack.append((here, node))
            pending = None
            if value[:1] == '"':
                node[key] = json.loads(value) if "\\" in value else value[1:-1]
            elif not value:
                node[key], pending = None, key
            else:
                node[key] = value == "true" if value in flags else int(value)
        return root

    return block


def parse_yaml(files: DataFrame, items: bool = False, mark: str | None = None) -> DataFrame:
    """``(_path, _start, _text)`` -> ``(_path, _doc, _item, _json)``: one row per document.

    ``_doc`` orders the documents of a file: their number, counted on from the first byte of
    the split (so it is dense in a file of one split).  With ``items`` a document that is a
    list gives one row per element instead, so no row holds a whole season.  ``mark`` is
    what the records were cut at.

    The parser is defined here so it is shipped to the Python workers by
    value: they need ``yaml`` and ``pyarrow``, not this package on their path.  A worker takes
    ``PARSE_ROWS`` records at a time out of an Arrow batch, so what it holds follows neither
    the split nor the batch in Python objects.
    """
    chunk_bytes, item_mark, parse_rows = YAML_CHUNK_BYTES, ITEM_MARK, PARSE_ROWS
    block = block_reader()

    def yaml_to_json(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import json

        import pyarrow
        import yaml

        loader = getattr(yaml, "CSafeLoader", yaml.SafeLoader)
        to_json = json.JSONEncoder(default=str, ensure_ascii=False).encode
        paths, idx, places, docs = [], [], [], []
        size = 0

        def flush():
            out = pyarrow.RecordBatch.from_pydict(
                {"_path": pyarrow.array(paths, pyarrow.string()), "_doc": pyarrow.array(idx, pyarrow.int64()),
                 "_item": pyarrow.array(places, pyarrow.int32()), "_json": pyarrow.array(docs, pyarrow.string())})
            paths.clear(), idx.clear(), places.clear(), docs.clear()
            return out

        def rows():
            for batch in batches:
                for at in range(0, batch.num_rows, parse_rows):
                    part = batch.slice(at, parse_rows)
                    yield from zip(*(part.column(c).to_pylist() for c in ("_path", "_start", "_text")))

        def records():
            """Records as YAML text, with what the delimiter took; lines that only look like one are put back."""
            now, held = None, None
            for path, start, text in rows():
                if mark is None:
                    yield path, start, text
                    continue
                new = (path, start) != now
                if mark != item_mark and text[:1].strip() and not (new and start == 0):     # ---x
                    if new:
                        raise ValueError(f"{path}: the split at byte {start} begins inside a document; read with whole=True")
                    held += "\n" + mark + text
                    continue
                if held is not None:
                    yield *now, held
                now, held = (path, start), text if new and start == 0 else mark + text
            if held is not None:
                yield *now, held

        count, last, single = 0, None, None
        for path, start, text in records():
            if path == single:
                raise ValueError(f"{path}: a list below a top-level map; read with whole=True")
            if (path, start) != last:
                count, last = 0, (path, start)
            if mark is not None and mark != item_mark:
                kept = text.rstrip().split("\n")
                while kept and kept[-1].startswith("%"):            # directives of the next document
                    kept.pop()
                    text = "\n".join(kept)
            simple = block(text) if mark is not None else None
            try:
                parsed = ([simple] if simple is not None else list(yaml.load_all(text, Loader=loader)) if mark is not None
                          else yaml.load_all(text, Loader=loader))
            except yaml.composer.ComposerError as exc:
                raise ValueError(f"{path}: {exc}; an anchor of another record needs whole=True") from exc
            if mark == item_mark and any(isinstance(doc, dict) for doc in parsed):
                single = path
            for doc in parsed:
                place, count = start + count, count + 1
                if doc is None:
                    continue
                for k, part in enumerate(doc if items and isinstance(doc, list) else [doc]):
                    paths.append(path)
                    idx.append(place)
                    places.append(k)
                    docs.append(to_json(part))
                    size += len(docs[-1])
                    if size >= chunk_bytes:
                        yield flush()
                        size = 0
        if docs:
            yield flush()

    return files.mapInArrow(yaml_to_json, PARSED)


def _parsed(spark: SparkSession, path: str, whole: bool) -> DataFrame:
    mark = None if whole else DOCUMENT_MARK
    return parse_yaml(document_text(spark, path, mark), mark=mark)


def read_documents(spark: SparkSession, path: str, schema: T.StructType, whole: bool = False) -> DataFrame:
    """SRC-1: map documents -> one typed row each, plus ``_path`` and ``_doc``."""
    return (_parsed(spark, path, whole).select("_path", "_doc", F.from_json("_json", schema).alias("r"))
            .select("_path", "_doc", "r.*"))


def read_document_maps(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """Map documents as ``map<string,string>`` in ``doc`` (keys in document order)."""
    return _parsed(spark, path, whole).select(
        "_path", "_doc", F.from_json("_json", T.MapType(T.StringType(), T.StringType())).alias("doc"))


def read_season_documents(spark: SparkSession, root: str, pattern: str = "*/entrants.yml",
                          flatten: bool = True, ordered: bool = False, strict: bool = False,
                          whole: bool = False, position: str | None = None) -> DataFrame:
    """SRC-2: ``<root>/<year>/entrants.yml`` (a list of entries) -> appearances.

    The year is the folder name (``1995`` or ``year=1995``), cast to int.
    With ``flatten`` the two nesting levels are expanded (NRM-6..9).
    ``ordered`` (SRT-1) sorts the output by numeric year, then path and place in the
    file, as the reference writes seasons in folder order.  It costs a range-partitioned
    sort, so it is off unless the row order of the written table matters.  A season is
    cut at the items of its list, so a large one is read by several tasks.
    ``position`` names a column that numbers the rows from 0 in that order instead, for
    tables whose row order is not kept.
    ``strict`` fails on an incomplete entry (see ``season_defect``).
    """
    mark = None if whole else ITEM_MARK
    files = document_text(spark, f"{root.rstrip('/')}/{pattern}", mark)
    return season_rows(files, flatten, ordered, strict, mark, position)


def season_defect(entry: F.Column) -> F.Column:
    """What an entry's JSON text lacks, or null: a constructor, a driver or the key ``rounds``.

    A null under the key ``rounds`` is complete: the driver did not take part.
    """
    def has(node, key):
        return F.array_contains(F.json_object_keys(node), key)

    def listed(node, key):
        return F.from_json(node, f"{key} array<string>").getField(key)

    def no_rounds(node):
        return F.when(~F.coalesce(has(node, "driverId"), F.lit(False)), "driverId").when(~has(node, "rounds"), "rounds")

    def below(node):
        drivers = listed(node, "drivers")
        return (F.when(has(node, "driverId"), no_rounds(node))
                .when(drivers.isNull(), F.lit("drivers"))
                .otherwise(F.try_element_at(F.filter(F.transform(drivers, no_rounds), lambda d: d.isNotNull()), F.lit(1))))

    constructors = listed(entry, "constructors")

    def constructor(node):
        return F.when(~F.coalesce(has(node, "constructorId"), F.lit(False)), "constructorId").otherwise(below(node))

    return (F.when(~F.coalesce(has(entry, "entrantId"), F.lit(False)), "entrantId")
            .when(has(entry, "constructorId"), below(entry))
            .when(constructors.isNull(), F.lit("constructors"))
            .otherwise(F.try_element_at(F.filter(F.transform(constructors, constructor), lambda d: d.isNotNull()),
                                        F.lit(1))))


def season_rows(files: DataFrame, flatten: bool = True, ordered: bool = False, strict: bool = False,
                mark: str | None = None, position: str | None = None) -> DataFrame:
    """``(_path, _start, _text)`` of season files (batch or stream) -> entries or appearances."""
    parsed = parse_yaml(files, items=True, mark=mark)
    text = F.col("_json")
    if strict:
        defect = season_defect(text)
        message = F.concat(F.lit("season entry lacks "), defect, F.lit(": "), F.col("_path"), F.lit(" "), text)
        text = F.when(defect.isNotNull(), F.raise_error(message).cast("string")).otherwise(text)
    place = ["_path", "_doc", "_item"]
    entries = parsed.select(year_from_path("_path").alias("year"), *place,
                            F.from_json(text, SEASON_ENTRY).alias("entry"))
    rows = flatten_entries(entries, order_cols=place) if flatten else entries
    places = [*place, "_c_pos", "_d_pos"] if flatten else place
    if position is not None:
        # Written once: the numbering reads its rows twice, for the range borders and for the sort.
        rows = materialize(rows, "season-rows")
        return with_dense_id(rows, ["year", *places], position).drop(*places)
    return (rows.orderBy("year", *places) if ordered else rows).drop(*places)


# --------------------------------------------------------------- YAML writing
# Characters that JSON leaves as they are and YAML folds or forbids, with their escapes.
_YAML_ESCAPES = {"\x7f": "\\u007f", "\x85": "\\u0085", "\u2028": "\\u2028", "\u2029": "\\u2029", "\ufeff": "\\ufeff"}


def yaml_quote(c) -> F.Column:
    """A string as a double-quoted YAML scalar with JSON escapes (null -> empty value).

    A text of printable ASCII without quote and backslash has no escapes; it is only quoted.
    """
    plain = c.cast("string")
    text = F.to_json(F.array(plain))
    text = text.substr(F.lit(2), F.length(text) - 2)
    for raw, escaped in _YAML_ESCAPES.items():
        text = F.replace(text, F.lit(raw), F.lit(escaped))
    return (F.when(c.isNull(), F.lit("")).when(plain.rlike(r"\A[ !#-\[\]-~]*\z"), F.concat(F.lit('"'), plain, F.lit('"')))
            .otherwise(text))


def yaml_number(c) -> F.Column:
    """A number as a YAML 1.1 scalar: Java's ``1.0E7`` needs an explicit exponent sign."""
    return F.when(c.isNull(), F.lit("")).otherwise(
        F.regexp_replace(c.cast("string"), r"E(\d)", "e+$1"))


def yaml_map_document(df: DataFrame, fields: dict[str, F.Column]) -> DataFrame:
    """One ``---``-prefixed YAML map document per row in column ``yaml``."""
    lines = [F.concat(F.lit(f"{k}: "), v) for k, v in fields.items()]
    return df.select(F.concat_ws("\n", F.lit("---"), *lines).alias("yaml"))


def write_yaml(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Write the ``yaml`` column as text files, rows joined by newlines.

    Files have at most ``YAML_FILE_DOCS`` rows.  With ``partition_by`` the rows are rebalanced
    first, so a folder has one file for each share that AQE cuts it into, however many tasks
    made its rows: readers cut the files at their records, and a stream that takes some
    files at a time has few micro-batches.
    """
    if partition_by:
        df.hint("rebalance", partition_by).write.mode("overwrite").partitionBy(partition_by).text(path)
    else:
        df.write.mode("overwrite").option("maxRecordsPerFile", YAML_FILE_DOCS).text(path)
