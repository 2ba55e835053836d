"""Document fingerprints by invertible Bloom lookup sketches, in SQL expressions only.

A document's paragraphs (lines, cut every ``PARAGRAPH`` characters from their beginning on) are
digested; each digest is added to one cell of each of four tables, a cell keeping the number and
the XOR of its digests. The cells are the fingerprint. Two fingerprints subtract cell by cell;
what both documents have cancels out, and the rest is peeled: a cell with one digest gives it
away, it is taken out of its other cells, and so on until no cell is left. The digests peeled are
the paragraphs added and removed, and their number gives the similarity of the paragraph sets.

When peeling stops early, the difference is too large for the cells: the digests are dealt to as
many parts as their number asks for, each with a sketch of its own; a part that fails is tried
again with four and sixteen times the cells and other hashes.

Digests are 48 bits of a hash, with 16 bits of check in the same integer, so that the XOR of
several digests is not taken for one.

Edge cases: a null text counts as empty; an empty text has no paragraph, and two of them are
alike (1.0); a paragraph that repeats within a document counts once; a lone document is its own
next one; null ids come first, rows of one id are in the order of a hash of their texts, and equal
rows are each other's next; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import documents, result, written

#: Characters of a paragraph at most.
PARAGRAPH = 160
#: Tables, and the power of two of the cells in each.
TABLES, BITS = 4, 3
#: Digests of a part on the second try, on average.
PART = 12
#: Quantiles of the ids; the driver holds them, so their number is fixed.
QUANTILES = 1024
#: Documents, on average, of a range in which they meet their next one, at most: what lies between two
#: quantiles is cut into as many ranges as that asks for.
RANGE_ROWS = 20_000
#: First documents of ranges that are broadcast (two numbers each); more are joined by a shuffle.
BROADCAST_ROWS = 100_000

_NO_CELL = "named_struct('n', 0, 'v', 0L)"


def _digests(text: str) -> str:
    """Distinct checked digests of the paragraphs of a text."""
    parts = f"regexp_extract_all({text}, '[^\\\\n]{{1,{PARAGRAPH}}}', 0)"
    short = f"transform({parts}, par -> shiftrightunsigned(xxhash64(par), 16))"
    return f"array_distinct(transform({short}, dig -> shiftleft(dig, 16) | (xxhash64(dig) & 65535L)))"


def _placed(digests: str, salt: int) -> str:
    """Digests with the hash that says where their cells are."""
    return f"transform({digests}, dg -> named_struct('v', dg, 'h', xxhash64(shiftrightunsigned(dg, 16), {salt})))"


def _place(item: str, index: str, bits: int) -> str:
    """Whether an item belongs to the cell of this index."""
    mask = (1 << bits) - 1
    return f"(shiftrightunsigned({item}.h, shiftright({index}, {bits}) * 10) & {mask}L) = ({index} & {mask})"


def _let(value: str, name: str, body: str, zero: str) -> str:
    """``body`` with a name for a value that is computed once."""
    return f"aggregate(array({value}), {zero}, (unused_{name}, {name}) -> {body})"


def _cells(placed: str, bits: int) -> str:
    each = (f"transform(sequence(0, {(TABLES << bits) - 1}), ci -> aggregate(filter(pl, it -> {_place('it', 'ci', bits)}), "
            f"{_NO_CELL}, (ac, it) -> named_struct('n', ac.n + 1, 'v', ac.v ^ it.v)))")
    return _let(placed, "pl", each, "cast(array() as array<struct<n:int,v:bigint>>)")


def _minus(a: str, b: str) -> str:
    return f"zip_with({a}, {b}, (ca, cb) -> named_struct('n', ca.n - cb.n, 'v', ca.v ^ cb.v))"


def _peel(cells: str, bits: int, salt: int, rounds: int) -> str:
    """(ok, added, removed, left) of a difference. Each round takes the lone digests of one table,
    which are in one cell of it only, out of all tables; it ends when no table has any."""
    width = 1 << bits
    table = f"slice(st.c, {width} * (rd % {TABLES}) + 1, {width})"
    lone = (f"filter(transform(filter(transform({table}, (ce, wi) -> named_struct('n', ce.n, 'v', ce.v, 'i', wi)), "
            f"lc -> abs(lc.n) = 1 and (lc.v & 65535L) = (xxhash64(shiftrightunsigned(lc.v, 16)) & 65535L)), "
            f"lc -> named_struct('n', lc.n, 'v', lc.v, 'i', lc.i, 'h', xxhash64(shiftrightunsigned(lc.v, 16), {salt}))), "
            f"ln -> (shiftrightunsigned(ln.h, (rd % {TABLES}) * 10) & {width - 1}L) = ln.i)")
    out = (f"transform(s2.c, (ce, cj) -> aggregate(filter(lone, lt -> {_place('lt', 'cj', bits)}), ce, "
           f"(ax, lt) -> named_struct('n', ax.n - lt.n, 'v', ax.v ^ lt.v)))")
    step = (f"if(st.z >= {TABLES}, st, aggregate(array({lone}), st, (s2, lone) -> if(size(lone) = 0, "
            f"named_struct('c', s2.c, 'p', s2.p, 'm', s2.m, 'z', s2.z + 1), named_struct('c', {out}, "
            f"'p', s2.p + size(filter(lone, lq -> lq.n > 0)), 'm', s2.m + size(filter(lone, lq -> lq.n < 0)), 'z', 0))))")
    left = "aggregate(en.c, 0, (ag, ce) -> ag + abs(ce.n))"
    return (f"aggregate(sequence(0, {rounds - 1}), named_struct('c', {cells}, 'p', 0, 'm', 0, 'z', 0), (st, rd) -> {step}, "
            f"en -> named_struct('ok', forall(en.c, ce -> ce.n = 0 and ce.v = 0L), 'added', en.p, 'removed', en.m, "
            f"'left', {left}))")


_NONE = "named_struct('ok', false, 'added', 0, 'removed', 0, 'left', 0)"


def _difference(a: str, b: str, bits: int, salt: int) -> str:
    return _peel(_minus(_cells(_placed(a, salt), bits), _cells(_placed(b, salt), bits)), bits, salt, TABLES * 6)


def _parts(a: str, b: str) -> str:
    """The difference of two arrays of digests, by parts, each tried with more and more cells. The
    digests are sorted by part once, so the work grows with their number, not with its square."""
    count = f"greatest(2, cast(ceil((size({a}) + size({b})) / {PART}) as int))"
    side = "transform({0}, dp -> named_struct('p', pmod(xxhash64(dp, 99), np), 's', {1}, 'v', dp))"
    dealt = f"sort_array(concat({side.format(a, 0)}, {side.format(b, 1)}))"
    starts = ("concat(filter(transform(dl, (dx, di) -> if(di = 0 or dx.p <> dl[di - 1].p, di, -1)), dy -> dy >= 0), "
              "array(size(dl)))")
    tries = _difference("pa", "pb", BITS + 4, 33)
    for bits, salt in ((BITS + 2, 32), (BITS, 31)):
        tries = _let(_difference("pa", "pb", bits, salt), f"t{salt}", f"if(t{salt}.ok, t{salt}, {tries})", _NONE)
    mine = "transform(filter(pt, dq -> dq.s = {0}), dq -> dq.v)"
    one = _let(mine.format(0), "pa", _let(mine.format(1), "pb", tries, _NONE), _NONE)
    part = "transform(sequence(ps, bs[pi + 1] - 1), dz -> dl[dz])"
    each = f"transform(slice(bs, 1, size(bs) - 1), (ps, pi) -> {_let(part, 'pt', one, _NONE)})"
    total = (f"aggregate({each}, named_struct('ok', true, 'added', 0, 'removed', 0, 'left', 0), (sm, pr) -> named_struct("
             f"'ok', sm.ok and pr.ok, 'added', sm.added + pr.added, 'removed', sm.removed + pr.removed, 'left', sm.left + pr.left))")
    return _let(count, "np", _let(dealt, "dl", _let(starts, "bs", total, _NONE), _NONE), _NONE)


def digests(text: str = "text") -> Column:
    """The paragraphs' digests of a text column."""
    return F.expr(_digests(f"coalesce({text}, '')"))


def cells(digests: str = "digests") -> Column:
    """The sketch of a column of digests."""
    return F.expr(_cells(_placed(digests, 1), BITS))


def as_string(cells: str = "cells") -> Column:
    """A sketch as text: number and XOR of each cell."""
    return F.expr(f"array_join(transform({cells}, ce -> concat(ce.n, '.', hex(ce.v))), ' ')")


def compare(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """Adds ``out``: (ok, added, removed, left) between the documents whose digests and cells are
    in the columns ``a``_digests, ``a``_cells and so on. Fingerprints first; larger sketches of
    the digests where these do not peel."""
    small = _peel(_minus(f"{b}_cells", f"{a}_cells"), BITS, 1, TABLES * 6)
    df = df.withColumn(f"_{out}", F.expr(small))
    return df.withColumn(out, F.expr(f"if(_{out}.ok, _{out}, {_parts(f'{b}_digests', f'{a}_digests')})")).drop(f"_{out}")


def likeness(diff: str, a: str, b: str) -> Column:
    """Similarity of the paragraph sets. What even the largest sketch left counts by its cells."""
    total = f"(size({a}_digests) + size({b}_digests))"
    changed = f"least({total}, {diff}.added + {diff}.removed + {diff}.left / {TABLES})"
    return F.expr(f"if({total} = 0, 1D, cast(({total} - {changed}) / ({total} + {changed}) as double))")


def _range(quantiles: list[int], parts: int) -> Column:
    """The number of the range of (doc_id, tie), never falling from one row to the next in their order.

    Null ids come first, then what lies between quantiles, cut evenly by id; an id that is several
    quantiles is cut by the hashes of its texts, and so are null ids.
    """
    bounds = sorted(set(quantiles))
    heavy = [x for x in bounds if quantiles.count(x) > 1]
    side = max(1, int(len(bounds) ** 0.5))
    steps = [bounds[i:i + side] for i in range(0, len(bounds), side)]
    longs = lambda values: "cast(array({}) as array<bigint>)".format(", ".join(f"{x}L" for x in values))
    nested = "array({})".format(", ".join(longs(x) for x in steps)) if steps else "array(cast(array() as array<bigint>))"
    top = f"size(filter({longs(x[0] for x in steps)}, tp -> tp < doc_id))"
    level = f"(greatest({top} - 1, 0) * {side} + size(filter(element_at({nested}, greatest({top}, 1)), tp -> tp < doc_id)))"
    by_text = f"least({parts - 1}, floor((cast(tie as double) / 18446744073709551616D + 0.5D) * {parts}))"
    if not bounds:
        return F.expr(f"cast({by_text} as long)")
    low = f"cast(element_at({longs(bounds)}, greatest(lv, 1)) as double)"
    high = f"cast(element_at({longs(bounds)}, least(lv + 1, {len(bounds)})) as double)"
    by_id = f"greatest(0, least({parts - 1}, floor((cast(doc_id as double) - {low}) / greatest({high} - {low}, 1D) * {parts})))"
    known = (f"if(array_contains({longs(heavy)}, doc_id), (2 * lv + 2) * {parts} + {by_text}, (2 * lv + 1) * {parts} + {by_id})")
    return F.expr(f"cast(if(doc_id is null, {by_text}, {_let(level, 'lv', f'cast({known} as bigint)', '0L')}) as long)")


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, digests, next_text, next_digests): each document and the one with the next id
    (the first, after the last), without a sort in one task.

    Ids are cut into ranges, as many as their number asks for. Each range is a window, and the
    first document of the next range joins it as its last row; texts are shuffled once.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    fractions = [i / QUANTILES for i in range(QUANTILES + 1)]
    count, quantiles = rows.agg(F.count("*"), F.percentile_approx("doc_id", fractions, 10 * QUANTILES)).first()
    parts = max(1, -(-count // (QUANTILES * RANGE_ROWS)))
    rows = rows.withColumn("range", _range(quantiles or [], parts))
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "tie")
    firsts = written(rows.groupBy("range").agg(F.min(place).alias("first")), "firsts")  # one row a range
    order = Window.partitionBy(F.lit(0)).orderBy("range")
    before = F.coalesce(F.lag("range").over(order), F.max("range").over(Window.partitionBy(F.lit(0))))
    few = firsts.count() <= BROADCAST_ROWS
    firsts = firsts.select("first.*", before.alias("before"))
    firsts = F.broadcast(firsts) if few else firsts
    edge = (rows.alias("r").join(firsts.alias("f"), F.expr("r.doc_id <=> f.doc_id and r.tie = f.tie"))
            .groupBy("f.before", "r.doc_id", "r.tie").agg(F.first("r.text").alias("text"))
            .select("doc_id", "text", F.col("before").alias("range"), "tie", F.lit(True).alias("edge")))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // RANGE_ROWS))
    rows = rows.withColumn("edge", F.lit(False)).unionByName(edge).repartition(tasks, "range").withColumn("digests", digests())
    w = Window.partitionBy("range").orderBy("edge", F.col("doc_id").asc_nulls_first(), "tie")
    for c in ("text", "digests"):
        rows = rows.withColumn(f"next_{c}", F.lead(c).over(w))
    return rows.filter("not edge").select("doc_id", "text", "digests", "next_text", "next_digests")


def fingerprint_versions(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    added, removed): each text against its edited version and the next document; ``added`` and
    ``removed`` count the paragraphs that the edit's difference gave back."""
    df = with_next(docs).withColumn("n", F.char_length("text")).withColumn("cut", F.expr("n div 4"))
    df = df.withColumn("edited", F.expr("concat(left(text, cast(n - cut as int)), left(next_text, cast(cut as int)))"))
    df = df.withColumn("edited_digests", digests("edited")).withColumnRenamed("digests", "own_digests")
    df = df.select("doc_id", F.col("n").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                   "own_digests", "next_digests", "edited_digests", cells("own_digests").alias("own_cells"),
                   cells("next_digests").alias("next_cells"), cells("edited_digests").alias("edited_cells"))
    df = compare(compare(df, "own", "edited", "edit"), "own", "next", "follow")
    return df.select("doc_id", "n_chars", "edited_sha256", as_string("own_cells").alias("fingerprint"),
                     as_string("edited_cells").alias("edited_fingerprint"), likeness("edit", "own", "edited").alias("near_edited"),
                     likeness("follow", "own", "next").alias("near_next"), F.col("edit.added").cast("long").alias("added"),
                     F.col("edit.removed").cast("long").alias("removed"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return result(lambda: fingerprint_versions(documents(spark, sf_dir)), "op3")
