"""Operator 8, sharding along a Hilbert curve (DataFrame expressions only).

Metadata dimensions (source, lang, number of characters) are quantised to 4 bits each and give a cell's
index on the Hilbert curve. Levels keep order: a text dimension is read as a number from the bytes after what all its
values begin with, and sixteenths of the rows (approximate quantiles, one row to the driver) cut it into levels. Rows
in curve order are cut into runs of equal counts, so the law is `rows`: shard sizes differ by one at most, and a
shard's files cover a narrow range of every dimension, which a reader's minimum and maximum statistics can skip.

The rank is counted, not sorted: cells (4096 at most, so their table is bounded and broadcast) are
counted, a cell is split into sub-cells by a hash of doc_id and text so that none holds more than about `split` rows,
sub-cells are counted, and a row's rank is its place in its sub-cell plus the rows before that. Sub-cells are added up
in blocks of BLOCK and blocks in their cell, so a hot source is ranked in many tasks. Cells, sub-cells and ties (doc_id,
then a hash of the text) depend on the rows alone, so a repeated task gives the same ranks.

Defined results: a null dimension is a value of its own, before all others (null length is 0); a null text has no bytes,
so size 1 and the CRC-32 of nothing, 0; a very long text counts as one row; equal texts with different doc_ids are
rows like any other, and rows that agree in all of doc_id and text take neighbouring slots in either order; an empty
table gives no rows; extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 4
BLOCK = 4096


def hilbert_index(coordinates: list[Column], bits: int = BITS) -> Column:
    """The place on the Hilbert curve of a cell with the given coordinates (each below 2**bits).

    One fold over the bit planes: each takes a bit from every axis, Gray-decodes them along the axes, and
    reflects or exchanges the lower bits of the first axis and the current one as the curve turns.
    """
    n = len(coordinates)
    axes = F.array(*(c.cast("int") for c in coordinates))
    steps = F.array(*(F.struct(F.lit(1 << b).alias("q"), F.lit(i + 1).alias("i")) for b in range(bits - 1, 0, -1) for i in range(n)))

    def turn(x: Column, s: Column) -> Column:
        low = s["q"] - 1
        here, first = F.element_at(x, s["i"]), F.element_at(x, 1)
        swap = (first.bitwiseXOR(here)).bitwiseAND(low)
        flipped = here.bitwiseAND(s["q"]) != 0
        return F.transform(x, lambda v, k: F.when(flipped & (k == 0), v.bitwiseXOR(low)).when(flipped, v).when((k == 0) | (k == s["i"] - 1), v.bitwiseXOR(swap)).otherwise(v))

    turned = F.aggregate(steps, axes, turn)
    gray = F.aggregate(F.slice(turned, 2, n - 1), F.slice(turned, 1, 1), lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1).bitwiseXOR(v))))
    last = lambda x: F.element_at(x, n)
    planes = F.array(*(F.lit(1 << b) for b in range(bits - 1, 0, -1)))

    def fix(x: Column) -> Column:
        t = F.aggregate(planes, F.lit(0), lambda acc, q: F.when(last(x).bitwiseAND(q) != 0, acc.bitwiseXOR(q - 1)).otherwise(acc))
        return F.transform(x, lambda v: v.bitwiseXOR(t))

    order = F.array(*(F.struct(F.lit(b).alias("b"), F.lit(i + 1).alias("i")) for b in range(bits - 1, -1, -1) for i in range(n)))
    done = fix(gray)
    # exchanged through a one-element array so that the fixed axes are worked out once
    return F.element_at(F.transform(F.array(done), lambda x: F.aggregate(order, F.lit(0), lambda acc, s: acc * 2 + F.when(F.element_at(x, s["i"]).bitwiseAND(F.element_at(F.array(*(F.lit(1 << b) for b in range(bits))), s["b"] + 1)) != 0, 1).otherwise(0))), 1)


def levels_of(docs: DataFrame, levels: int) -> list[Column]:
    """An order-preserving level below `levels` for each of source, lang and the number of characters."""
    words = ("source", "lang")
    ends = docs.agg(*(f(F.col(c).cast("string")).alias(f"{c}_{n}") for c in words for n, f in (("low", F.min), ("high", F.max)))).head()
    codes = []
    for c in words:
        low, high = (x.encode() if x else b"" for x in (ends[f"{c}_low"], ends[f"{c}_high"]))
        same = next((k for k, (x, y) in enumerate(zip(low, high, strict=False)) if x != y), min(len(low), len(high)))
        raw = F.hex(F.substring(F.encode(F.col(c).cast("string"), "UTF-8"), same + 1, 6))
        codes.append(F.coalesce(F.conv(F.rpad(raw, 12, "0"), 16, 10).cast("long"), F.lit(-1)))
    codes.append(F.greatest(F.coalesce(F.col("n_chars").cast("long"), F.lit(0)), F.lit(0)))
    cuts = docs.agg(*(F.percentile_approx(x, [k / levels for k in range(1, levels)], 10_000).alias(f"q{k}") for k, x in enumerate(codes))).head()
    return [sum(((x > v).cast("int") for v in sorted(set(cuts[f"q{k}"] or []))), F.lit(0)) for k, x in enumerate(codes)]


def shard(docs: DataFrame, shards: int = 16, split: int = 1_000) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and the curve index of each row of docs."""
    levels = 1 << BITS
    text = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8")
    one, two, three = levels_of(docs, levels)
    cell = ((one * levels + two) * levels + three).cast("int")
    tie = F.xxhash64("doc_id", "text")

    # the curve is worked out for each cell, not for each row
    at = lambda k: F.pmod(F.shiftright("cell", BITS * k), F.lit(levels))
    per_cell = docs.select(cell.alias("cell")).groupBy("cell").agg(F.count("*").alias("in_cell")).withColumn("curve", hilbert_index([at(2), at(1), at(0)]))
    upto = Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)
    cells = per_cell.select("cell", "curve", F.ceil(F.col("in_cell") / split).alias("subs"), F.coalesce(F.sum("in_cell").over(upto), F.lit(0)).alias("cell_base"), F.sum("in_cell").over(Window.partitionBy()).alias("all_rows"))
    cells = F.broadcast(cells)  # 4096 rows at most

    def placed(rows: DataFrame) -> DataFrame:
        return rows.join(cells, "cell").withColumn("sub", F.pmod("tie", "subs"))

    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    counts = placed(docs.select(tie.alias("tie"), cell.alias("cell"))).groupBy("cell", "sub").agg(F.count("*").alias("in_sub")).withColumn("block", F.expr(f"sub div {BLOCK}"))
    blocks = counts.groupBy("cell", "block").agg(F.sum("in_sub").alias("in_block")).select("cell", "block", F.coalesce(F.sum("in_block").over(before(Window.partitionBy("cell").orderBy("block"))), F.lit(0)).alias("block_base"))
    within_block = F.coalesce(F.sum("in_sub").over(before(Window.partitionBy("cell", "block").orderBy("sub"))), F.lit(0))
    subs = counts.withColumn("within_block", within_block).join(blocks, ["cell", "block"]).select("cell", "sub", (F.col("within_block") + F.col("block_base")).alias("sub_base"))
    rows = placed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), tie.alias("tie"), cell.alias("cell")))
    within = F.row_number().over(Window.partitionBy("cell", "sub").orderBy("doc_id", "tie")) - 1
    ranked = rows.withColumn("within", within).join(subs, ["cell", "sub"])
    rank = F.col("cell_base") + F.col("sub_base") + F.col("within")
    exact = F.expr(f"(cell_base + sub_base + within) * {shards} div all_rows")
    first = F.expr(f"(shard_no * all_rows + {shards - 1}) div {shards}")
    return ranked.withColumn("shard_no", exact).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard_no").cast("int").alias("shard"), (rank - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), F.col("curve").cast("int").alias("curve"))
