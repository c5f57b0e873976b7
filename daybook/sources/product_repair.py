"""Repair of a damaged product dump: records put together again and realigned.

Two kinds of damage come from programs that read the dump line by line and wrote it
back:

* a quoted text with line breaks was cut there, and each piece was filled up with
  empty fields to the width of a record;
* a text with a comma lost its quotes, so every field behind it stands one place on.

**Reassembly.** Lines are read by any number of tasks, keep their place (file, begin of
the split, place in it), and a record's first line, the one that begins with a key, is
carried forward over the lines after it (``operators.ordered.carry``).  The lines of a
record are joined by line breaks, without the filling.

**Realignment.** A record's pieces between commas (outside quotes, as far as these are
balanced) are matched with the 46 field types by dynamic programming: every field
takes the next piece, a text may take several; a text that would swallow an empty
piece, or a comma without a blank behind it, costs more.  Empty pieces left at the end
are filling.  A record that fits no way, because fields are lost or values are of no
type, is a reject with its raw text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators.ordered import carry
from daybook.session import Scope
from daybook.sources.product_csv import N_FIELDS, PRODUCT_SCHEMA, TS_FORMAT

#: A record's first line begins with its key; the control line of an extract is none.
FIRST_LINE = r'^"?[0-9a-f]{32}"?,'
CONTROL_LINE = r"^\d{3}, \d{8}, \d+$"

_KINDS = {
    T.BooleanType: re.compile(r"(?i)true|false"),
    T.TimestampNTZType: re.compile(r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d(\.\d+)?"),
    T.DoubleType: re.compile(r"[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?"),
    T.DecimalType: re.compile(r"[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?"),
    T.StringType: None,
}
_PATTERNS = [_KINDS[type(f.dataType)] for f in PRODUCT_SCHEMA.fields]
#: What a merge of two pieces costs: at a comma with a blank behind it, at another, with
#: an empty piece.
_AT_BLANK, _AT_COMMA, _WITH_EMPTY = 1, 2, 10


def split_pieces(record: str) -> list[tuple[str, bool]]:
    """The pieces between commas and whether each was quoted; without regard to quotes
    if these are not balanced."""
    if record.count('"') % 2:
        return [(x, False) for x in record.split(",")]
    out, at = [], 0
    while True:
        if record.startswith('"', at):
            end = at + 1
            while True:
                end = record.index('"', end)
                if record.startswith('""', end):
                    end += 2
                    continue
                break
            stop = record.find(",", end)
            stop = len(record) if stop < 0 else stop
            out.append((record[at + 1:end].replace('""', '"') + record[end + 1:stop], True))
        else:
            stop = record.find(",", at)
            stop = len(record) if stop < 0 else stop
            out.append((record[at:stop], False))
        if stop >= len(record):
            return out
        at = stop + 1


def align(pieces: list[tuple[str, bool]], null_text: str) -> list[str | None] | None:
    """The 46 field texts (None: empty) of the cheapest way to deal the pieces, first
    the one that merges earlier; None if there is no way."""
    texts = [x for x, _ in pieces]
    empty = [not q and (x == "" or x == null_text) for x, q in pieces]

    def fits(field: int, i: int) -> bool:
        return empty[i] or _PATTERNS[field] is None or bool(_PATTERNS[field].fullmatch(texts[i]))

    n, far = len(pieces), float("inf")
    tail = n
    while tail > N_FIELDS and empty[tail - 1]:
        tail -= 1                                       # pieces beyond can only be filling
    if n < N_FIELDS:
        return None
    if n == N_FIELDS and all(fits(f, f) for f in range(n)):
        return [None if empty[i] else texts[i] for i in range(n)]
    # cost[f][i]: the first i + 1 pieces in the first f + 1 fields, the last one in field f
    cost, merged = [[far] * n for _ in range(N_FIELDS)], [[False] * n for _ in range(N_FIELDS)]
    for f in range(N_FIELDS):
        for i in range(f, n):
            if fits(f, i):
                cost[f][i] = 0 if f == i == 0 else cost[f - 1][i - 1] if f and i else far
            if i > f and _PATTERNS[f] is None and cost[f][i - 1] < far:
                step = _WITH_EMPTY if empty[i] or empty[i - 1] else _AT_BLANK if texts[i].startswith(" ") else _AT_COMMA
                if cost[f][i - 1] + step < cost[f][i]:
                    cost[f][i], merged[f][i] = cost[f][i - 1] + step, True
    ends = [(cost[-1][i], -i) for i in range(max(N_FIELDS, tail) - 1, n) if all(empty[i + 1:])]
    best, last = min(ends, default=(far, 0))
    if best == far:
        return None
    f, i, out = N_FIELDS - 1, -last, []
    end = i
    while f >= 0:
        if merged[f][i]:
            i -= 1
            continue
        out.append(None if i == end and empty[i] else ",".join(texts[i:end + 1]))
        f, i = f - 1, i - 1
        end = i
    return out[::-1]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, block, id, line) of every line; the three order the lines of a file."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), F.col("value").alias("line"))


def reassemble(spark: SparkSession, path: str, scope: Scope, null_text: str = "None") -> DataFrame:
    """(record) texts of a dump's records, and of what stands before a file's first one.
    The control line is left out."""
    lines = _lines(spark, path).filter(~F.col("line").rlike(CONTROL_LINE))
    head = F.when(F.col("line").rlike(FIRST_LINE), F.struct("path", "block", "id"))
    owned = carry(lines.withColumn("head", head), ["path", "block", "id"], "head", "owner", scope)
    own = F.when(F.col("owner.path") == F.col("path"), F.col("owner"))      # not a record of the file before
    parts = owned.select("path", F.coalesce(own, F.struct("path", "block", "id")).alias("owner"), F.struct("block", "id", "line").alias("part"))
    records = parts.groupBy("path", "owner").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    filling = r"(,(" + re.escape(null_text) + r")?)+$"
    last = F.size("parts") - 1
    joined = F.transform("parts", lambda p, i: F.when(i < last, F.regexp_replace(p["line"], filling, "")).otherwise(p["line"]))
    return records.select(F.array_join(joined, "\n").alias("record"))


def _typed(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampNTZType):
        return F.to_timestamp_ntz(text, F.lit(TS_FORMAT))
    return text if isinstance(kind, T.StringType) else text.try_cast(kind)


def repair_product_dump(spark: SparkSession, path: str, scope: Scope, null_text: str = "None") -> tuple[DataFrame, DataFrame]:
    """``(records, rejects)`` of a dump: the records with ``PRODUCT_SCHEMA``, and the raw
    texts (``record``) that fit no way."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column(0).to_pylist()
            got = [align(split_pieces(x), null_text) for x in raw]
            yield pa.RecordBatch.from_pydict({"record": pa.array([x if g is None else None for x, g in zip(raw, got, strict=True)], pa.string()),
                                              "fields": pa.array(got, pa.list_(pa.string()))})

    found = scope.save(reassemble(spark, path, scope, null_text).mapInArrow(run, "record string, fields array<string>"), "product-records")
    records = found.filter(F.col("record").isNull()).select(
        *[_typed(F.get("fields", F.lit(i)), f.dataType).alias(f.name) for i, f in enumerate(PRODUCT_SCHEMA.fields)])
    return records, found.filter(F.col("record").isNotNull()).select("record")


def damaged_lines(records: DataFrame) -> DataFrame:
    """(line) texts of a damaged dump of ``records`` (``PRODUCT_SCHEMA``): by the number in
    ``id``, every second record is cut at its line breaks and filled up, every fourth has
    a text with a comma and no quotes, every sixteenth has lost its last fields."""
    no, fields = F.regexp_extract("id", r"(\d+)", 1).cast("long"), []
    for i, f in enumerate(PRODUCT_SCHEMA.fields):
        text = F.coalesce(F.col(f.name).cast("string"), F.lit("None"))
        if i == 6:
            quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
            filled = F.replace(quoted, F.lit("\n"), F.lit(",None" * 39 + "\n"))
            text = F.when(no % 4 == 2, text).when(no % 2 == 1, filled).otherwise(quoted)
        fields.append(text)
    whole = F.concat_ws(",", *fields)
    return records.select(F.when(no % 16 == 15, F.concat_ws(",", *fields[:40])).when(no % 2 == 1, F.concat(whole, F.lit(",None" * 6)))
                          .otherwise(whole).alias("line"))
