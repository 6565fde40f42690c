"""Documents read by the schema they have: their leaves as rows, merged by preference, and nested results."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Levels of a document that are opened; what lies deeper stays one value, as JSON text.
LEVELS = 4
#: Paths whose parts a task remembers.
KNOWN_PATHS = 100_000
_ESCAPED = re.compile(r'["\\\x00-\x1f]')


def leaves(df: DataFrame, document: str, keep: list[str], levels: int = LEVELS) -> DataFrame:
    """Rows (*keep, path, kind, value): what each JSON document says, by path (keys joined by `.`).

    kind is `list` for arrays and `value` for all else; value is JSON text. JSON nulls, empty
    objects, null documents and those that are no JSON objects say nothing; each key of a path
    is written as it is, so keys that hold a point can meet others. A document's rows stay its own: repeated
    documents give repeated rows.
    """
    spark = df.sparkSession
    at = df.select(*keep, F.lit("").alias("path"), F.try_parse_json(F.col(document)).alias("node"))
    kind = lambda c: F.coalesce(F.schema_of_variant(c), F.lit("VOID"))
    # One pass: an object gives a row a key at each level, all else goes on as it is.
    for _ in range(levels):
        told = at.withColumn("__open", kind(F.col("node")).startswith("OBJECT"))
        opened = told.lateralJoin(spark.tvf.variant_explode_outer(F.when(F.col("__open"), F.col("node")).outer())).where(~F.col("__open") | F.col("key").isNotNull())
        below = F.concat(F.when(F.col("path") != "", F.concat(F.col("path"), F.lit("."))).otherwise(""), F.col("key"))
        at = opened.select(*keep, F.when(F.col("__open"), below).otherwise(F.col("path")).alias("path"), F.when(F.col("__open"), F.col("value")).otherwise(F.col("node")).alias("node"))
    shape = kind(F.col("node"))
    return at.where((F.col("path") != "") & (shape != "VOID")).select(*keep, "path", F.when(shape.startswith("ARRAY"), "list").otherwise("value").alias("kind"), F.to_json("node").alias("value"))


def _quoted(name: str) -> str:
    """A name as JSON text, escaped as Spark writes it."""
    if not _ESCAPED.search(name):
        return f'"{name}"'
    short = {'"': '\\"', "\\": "\\\\", "\b": "\\b", "\t": "\\t", "\n": "\\n", "\f": "\\f", "\r": "\\r"}
    return '"' + "".join(short.get(c) or (f"\\u{ord(c):04X}" if c < " " else c) for c in name) + '"'


class _Paths(dict):
    """Of each path its parts, their names as JSON text, and the paths above it."""

    def __missing__(self, path):
        if len(self) >= KNOWN_PATHS:
            self.clear()
        parts = path.split(".")
        told = self[path] = (parts, [_quoted(k) for k in parts], [".".join(parts[:k]) for k in range(1, len(parts))])
        return told


def _text(found: Iterable[tuple[str, str]], known: _Paths) -> str:
    """One JSON text of the leaves (path, value) of a document; what a leaf closes and opens is seen from the one before it."""
    told = [(*known[path][:2], value) for path, value in found]
    told.sort(key=lambda x: (x[0], x[2]))
    text, before = [], []
    for parts, names, value in told:
        same, most = 0, min(len(parts), len(before)) - 1
        while same < most and parts[same] == before[same]:
            same += 1
        if before:
            text.append("}" * (len(before) - 1 - same) + ",")
        text += [":{".join(names[same:]) if same else ":{".join(names), ":", value]
        before = parts
    return "{" + "".join(text) + "}" * len(before)


def _values(column: pa.Array) -> list:
    """A column's values; texts and whole numbers by way of numpy, which is faster."""
    plain = pa.types.is_string(column.type) or (pa.types.is_integer(column.type) and not column.null_count)
    return column.to_numpy(zero_copy_only=False).tolist() if plain else column.to_pylist()


class _Number(str):
    """A number as it is written."""


def _json(value) -> str:
    """JSON text of what was read with numbers as they are written."""
    kind = type(value)
    if kind is _Number:
        return value
    if kind is str:
        return _quoted(value)
    if kind is list:
        return "[" + ",".join(map(_json, value)) + "]"
    if kind is dict:
        return "{" + ",".join(f"{_quoted(k)}:{_json(v)}" for k, v in value.items()) + "}"
    return {None: "null", True: "true", False: "false"}[value]


def _opened(node: dict, levels: int, above: str, found: list[tuple[str, str, list[str] | None]]) -> list[tuple[str, str, list[str] | None]]:
    """``found`` and (path, value, items of a list) of what an object says, as ``leaves`` tells it."""
    for name, value in node.items():
        path = f"{above}.{name}" if above else name
        if type(value) is dict and levels > 1:
            _opened(value, levels - 1, path, found)
        elif value is not None and path:
            items = list(map(_json, value)) if type(value) is list else None
            found.append((path, _json(value) if items is None else "[" + ",".join(items) + "]", items))
    return found


def _merged(whole: bool, opener: Callable[[], Callable[..., Iterable[tuple[str, str, list[str] | None]]]]):
    """Makes of rows (key, rank, source, ...) in that order, whose rest what ``opener`` gives makes leaves of, what is left of each key: rows (key, path, value, sources), or with ``whole`` rows (key, document).

    Of a key is held what is merged so far: [place in the order, source, is no list, value, lists] by path.
    """

    def left(paths, known):
        """(path, value, sources) of a key; of paths above and below each other those of the preferred."""
        lost = set()
        for path in paths:
            for above in known[path][2]:
                if above in paths:
                    lost.add(above if paths[path][0] < paths[above][0] else path)
        for path, (_, source, plain, value, lists) in paths.items():
            if path in lost:
                continue
            if plain:
                yield path, value, [source]
            else:
                lists.sort(key=lambda x: x[:2])
                yield path, "[" + ",".join(dict.fromkeys(x for told in lists for x in told[2])) + "]", sorted({told[3] for told in lists if told[3] is not None})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = opener()
        known, key, by, place, paths, made = _Paths(), None, None, 0, {}, []

        def done():
            if whole and paths:
                made.append((key, _text([(path, value) for path, value, _ in left(paths, known)], known)))
            elif paths:
                made.extend([(key, *row) for row in left(paths, known)])

        def batch_of(batch):
            types = [pa.string()] if whole else [pa.string(), pa.string(), pa.list_(batch.schema.field("source").type)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), [batch.schema.field("key").type, *types], strict=True)], ["key", "document"] if whole else ["key", "path", "value", "sources"])

        for batch in batches:
            for k, rank, source, *rest in zip(*(_values(c) for c in batch.columns), strict=True):
                if k != key:
                    done()
                    key, by, place, paths = k, None, 0, {}
                if by != (rank, source):
                    by, place = (rank, source), place + 1
                for path, value, items in opened(*rest):
                    at = paths.get(path)
                    if at is None:
                        at = paths[path] = [place, source, items is None, value, []]
                    elif at[0] == place and (items is None, value) < (at[2], at[3]):
                        at[2:4] = items is None, value
                    if items is not None:
                        at[4].append((place, value, items, source))
            if made:
                yield batch_of(batch)
                made = []
        done()
        if made:
            yield batch_of(batch)

    return merge


def merged_leaves(found: DataFrame, key: str, rank: str, source: str) -> DataFrame:
    """Rows (key, path, value, sources): the documents of one key as one, by path.

    Of values the one of the lowest ``rank`` counts, ties to the smaller source; lists are joined in
    that order without repeats. Where one document has a value and another goes deeper, the
    preferred one decides. ``sources`` are those that gave what is kept. Null keys go.

    Leaves are dealt by key once (not again, if they come so) and merged in order, inside tasks.
    """
    items = F.array_join(F.transform(F.from_json("value", "array<variant>"), lambda v: F.to_json(v)), "\n")  # JSON text has no line ends
    told = found.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(rank).alias("rank"), F.col(source).alias("source"), "path", "value", F.when(F.col("kind") == "list", F.coalesce(items, F.lit(""))).alias("items"))
    leaf = lambda path, value, items: ((path, value, None if items is None else items.split("\n") if items else []),)
    types = {f.name: f.dataType.simpleString() for f in found.schema.fields}
    merged = told.repartition("key").sortWithinPartitions("key", "rank", "source").mapInArrow(_merged(False, lambda: leaf), f"key {types[key]}, path string, value string, sources array<{types[source]}>")
    return merged.withColumnRenamed("key", key)


def merged_documents(df: DataFrame, document: str, key: str, rank: str, source: str, levels: int = LEVELS) -> DataFrame:
    """(key, document): the JSON ``document`` texts of one key as one, by the rules of ``leaves`` and ``merged_leaves``, keys in order.

    Documents are dealt by key once (not again, if they come so), and their leaves are no rows.
    """
    told = df.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(rank).alias("rank"), F.col(source).alias("source"), F.to_json(F.try_parse_json(F.col(document))).alias("text"))

    def opener():
        read = json.JSONDecoder(parse_int=_Number, parse_float=_Number).decode
        return lambda text: _opened(read(text), levels, "", []) if text is not None and text.startswith("{") else ()

    merged = told.repartition("key").sortWithinPartitions("key", "rank", "source").mapInArrow(_merged(True, opener), f"key {df.schema[key].dataType.simpleString()}, document string")
    return merged.withColumnRenamed("key", key)


def documents(leaf: DataFrame, key: str) -> DataFrame:
    """(key, document): one JSON text of the leaves (key, path, value) of each key; keys in order. Null keys go."""

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, key, held = _Paths(), None, []
        for batch in batches:
            kind, made = batch.schema.field(0).type, []
            for k, path, value in zip(*(_values(c) for c in batch.columns), strict=True):
                if k != key:
                    made += [(key, _text(held, known))] if held else []
                    key, held = k, []
                held.append((path, value))
            if made:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in made], kind), pa.array([r[1] for r in made], pa.string())], ["key", "document"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([key], kind), pa.array([_text(held, known)], pa.string())], ["key", "document"])

    rows = leaf.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), "path", "value").repartition("key").sortWithinPartitions("key")
    return rows.mapInArrow(assemble, f"key {leaf.schema[key].dataType.simpleString()}, document string").withColumnRenamed("key", key)


def hierarchy(df: DataFrame, levels: list[str]) -> DataFrame:
    """Rows of the first level: (name, value, children), children an array of such structs down the levels, the last with name and value alone.

    Rows are counted once, then summed level by level from below; the largest first, ties by name. Null
    names are `Unknown`. Meant for levels of few values, as a first level's tree is one row.
    """
    names = [f"l{k}" for k in range(len(levels))]
    named = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("Unknown")).alias(n) for c, n in zip(levels, names, strict=True)])
    at = named.groupBy(*names).agg(F.count("*").alias("value"))
    node = lambda n, more: F.struct((-F.col("value")).alias("__less"), F.col(n).alias("name"), "value", *more)
    more: list[str] = []
    for k in range(len(names) - 1, 0, -1):
        listed = F.array_sort(F.collect_list(node(names[k], more)))
        children = F.transform(listed, lambda x: F.struct(x["name"].alias("name"), x["value"].alias("value"), *[x[m].alias(m) for m in more]))  # noqa: B023
        at = at.groupBy(*names[:k]).agg(F.sum("value").alias("total"), children.alias("children")).withColumnRenamed("total", "value")
        more = ["children"]
    return at.select(F.col("l0").alias("name"), "value", *more)
