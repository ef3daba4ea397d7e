"""How many values each pair of columns shares, without a pair per value.

*Pruning.* A column goes into the shuffle only if some column of the other role
can print a value that it prints: printed forms must agree (a date is never a
whole number) and ranges must meet. That is told from the profiles alone.

*Signatures.* One shuffle brings a value's columns together, as a 128-bit digest
of the value and a column's number; a value meets at most as many rows as there
are columns. Inside a task, values held by the same set of columns (their
signature) are counted as one with a weight.

*Counting.* A signature of few columns is expanded into its pairs. Those that a
large part of all columns share, as of small integers in a wide estate, are hot:
their column sets become rows of 0/1 matrices, and all pairs are counted by one
weighted matrix product a block, however many of them each signature has. Tasks
hand on sums per pair, never pairs per value.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that a task counts at a time, cells of a matrix, pairs that are expanded at a time.
ROWS = 1 << 18
CELLS = 1 << 20
#: A signature is hot if its pairs are more than this share of all pairs of columns.
HOT = 1 / 200

ORDINAL_BITS = 20

#: Printed forms, by the types' names; strings, binary and the rest may print anything.
FORMS = {"ByteType()": "whole", "ShortType()": "whole", "IntegerType()": "whole", "LongType()": "whole",
         "FloatType()": "fraction", "DoubleType()": "fraction", "BooleanType()": "flag", "DateType()": "date",
         "TimestampType()": "time", "TimestampNTZType()": "time"}
#: The texts a form prints lie between these (by bytes).
SPAN = {"whole": ("+", ":"), "fraction": ("+", "O"), "flag": ("f", "u"), "date": ("+", ":"), "time": ("+", ":")}


# ---- columns that can match ---------------------------------------------------------

def printed_form() -> Column:
    form = F.when(F.col("dtype").rlike(r"^DecimalType\(\d+,0\)$"), "whole").when(F.col("dtype").startswith("DecimalType"), "fraction")
    for dtype, name in FORMS.items():
        form = form.when(F.col("dtype") == dtype, name)
    return form.otherwise("any")


def _spans(columns: DataFrame) -> DataFrame:
    """``columns`` with form, and the least and greatest text (and number, for numbers) they can print."""
    form = printed_form()
    low, high = F.col("min_value"), F.col("max_value")
    for name, (a, b) in SPAN.items():
        low, high = F.when(form == name, F.lit(a)).otherwise(low), F.when(form == name, F.lit(b)).otherwise(high)
    return columns.withColumns({"form": form, "low": low, "high": high}).filter(F.col("low").isNotNull())


def can_match(fks: DataFrame, pks: DataFrame) -> DataFrame:
    """(dataset_id, ordinal, is_pk) of the columns that may share a value with one of the other role."""
    sides = _spans(fks.withColumn("is_pk", F.lit(False)).unionByName(pks.withColumn("is_pk", F.lit(True))))
    # one row a role and form: a dozen
    hulls = sides.groupBy("is_pk", "form").agg(F.min("low").alias("low"), F.max("high").alias("high"),
                                               F.min("min_num").alias("a"), F.max("max_num").alias("b")).collect()
    meets = F.lit(False)
    for h in hulls:
        other = F.col("is_pk") != F.lit(h["is_pk"])
        numbers = (F.col("min_num") <= F.lit(h["b"])) & (F.col("max_num") >= F.lit(h["a"]))
        texts = (F.col("low") <= F.lit(h["high"])) & (F.col("high") >= F.lit(h["low"]))
        if h["form"] == "any":
            meets = meets | (other & texts)
        else:
            same = F.col("form") == h["form"]
            if h["form"] in ("whole", "fraction"):
                same = same & F.coalesce(numbers, F.lit(True))
            meets = meets | (other & (same | ((F.col("form") == "any") & texts)))
    return sides.filter(meets).select("dataset_id", "ordinal", "is_pk")


# ---- counting -----------------------------------------------------------------------

def _mixed(x: np.ndarray, by: int) -> np.ndarray:
    x = (x.astype(np.uint64) + np.uint64(by)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] of them), then those from start[1] on, ..."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def count_pairs(h1: np.ndarray, h2: np.ndarray, column: np.ndarray, is_pk: np.ndarray
                ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(fk column, pk column, values that both hold), a pair perhaps several times.
    Rows of one value stand together; a value is there once for each of its columns."""
    if not len(h1):
        return
    fresh = np.concatenate(([True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
    start = np.flatnonzero(fresh)
    size = np.diff(np.append(start, len(h1)))
    n_pk = np.add.reduceat(is_pk.astype(np.int64), start)
    both = (n_pk > 0) & (n_pk < size)
    start, size, n_pk = start[both], size[both], n_pk[both]
    if not len(start):
        return
    # equal column sets are one signature
    at = _ranges(start, size)
    head = np.cumsum(size) - size
    sign = [np.add.reduceat(_mixed(column[at], k), head) for k in (1, 2)]
    order = np.argsort(sign[0], kind="stable")
    differs = np.concatenate(([True], np.any([x[order][1:] != x[order][:-1] for x in sign], axis=0)))
    one = order[differs]
    times = np.diff(np.append(np.flatnonzero(differs), len(order)))
    start, size, n_pk = start[one], size[one], n_pk[one]
    at = _ranges(start, size)
    # FK columns first within each signature
    group = np.repeat(np.arange(len(size)), size)
    at = at[np.lexsort((is_pk[at], group))]
    fk, pk = at[~is_pk[at]], at[is_pk[at]]
    fks, f = np.unique(column[fk], return_inverse=True)
    pks, p = np.unique(column[pk], return_inverse=True)
    n_fk = size - n_pk
    f_head, p_head = np.cumsum(n_fk) - n_fk, np.cumsum(n_pk) - n_pk
    pairs = n_fk * n_pk
    hot = pairs > HOT * len(fks) * len(pks)
    cold = np.flatnonzero(~hot | (pairs <= 4))
    hot = np.flatnonzero(hot & (pairs > 4))

    cut = np.searchsorted(np.cumsum(pairs[cold]), np.arange(CELLS, int(pairs[cold].sum()) + CELLS, CELLS))
    for some in np.split(cold, np.unique(cut)):
        if not len(some):
            continue
        each = np.repeat(some, n_fk[some])  # the signature of each FK entry
        left = np.repeat(f[_ranges(f_head[some], n_fk[some])], n_pk[each])
        right = p[_ranges(p_head[each], n_pk[each])]
        weight = np.repeat(times[each], n_pk[each])
        code = left * len(pks) + right
        if len(fks) * len(pks) <= CELLS:
            total = np.bincount(code, weights=weight, minlength=len(fks) * len(pks))
            code = np.flatnonzero(total)
            total = total[code]
        else:
            code, back = np.unique(code, return_inverse=True)
            total = np.bincount(back, weights=weight)
        yield fks[code // len(pks)], pks[code % len(pks)], total.astype(np.int64)

    if not len(hot):
        return
    rows = max(1, CELLS // (len(fks) + len(pks)))
    strip = max(1, CELLS // len(pks))  # FK columns whose sums are held at a time
    for c in range(0, len(fks), strip):
        total = np.zeros((min(strip, len(fks) - c), len(pks)))
        for k in range(0, len(hot), rows):
            some = hot[k:k + rows]
            left, right = np.zeros((len(some), len(total))), np.zeros((len(some), len(pks)))
            row, col = np.repeat(np.arange(len(some)), n_fk[some]), f[_ranges(f_head[some], n_fk[some])] - c
            ok = (col >= 0) & (col < len(total))
            left[row[ok], col[ok]] = times[some][row[ok]]
            right[np.repeat(np.arange(len(some)), n_pk[some]), p[_ranges(p_head[some], n_pk[some])]] = 1
            total += left.T @ right  # whole numbers below 2**53: exact
        i, j = np.nonzero(total)
        yield fks[c + i], pks[j], total[i, j].astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (h1, h2) -> sums per pair of columns, block by block."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0

    def out(rows: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
        for f, p, n in count_pairs(rows[0], rows[1], rows[2] >> 1, (rows[2] & 1).astype(bool)):
            yield pa.RecordBatch.from_arrays([pa.array(f), pa.array(p), pa.array(n)], ["fk", "pk", "n"])

    for batch in batches:
        held.append(tuple(batch.column(c).to_numpy() for c in ("h1", "h2", "code")))
        size += batch.num_rows
        if size >= ROWS:
            rows = tuple(map(np.concatenate, zip(*held)))
            # the last value may go on in the next batch
            last = np.flatnonzero((rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            yield from out(tuple(x[:cut] for x in rows))
            held, size = [tuple(x[cut:] for x in rows)], len(rows[0]) - cut
    if held:
        yield from out(tuple(map(np.concatenate, zip(*held))))


def matched_pairs(keyed: DataFrame) -> DataFrame:
    """``keyed``: (dataset_id, ordinal, is_pk, key), a value once for each column that holds it, and no
    nulls -> (fk_dataset, fk_ordinal, pk_dataset, pk_ordinal, matched) of different datasets."""
    column = F.shiftleft(F.col("dataset_id").cast("long"), ORDINAL_BITS) + F.col("ordinal")
    rows = keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2"),
                        (2 * column + F.col("is_pk").cast("long")).alias("code"))
    sums = (rows.repartition(F.col("h1")).sortWithinPartitions("h1", "h2")
            .mapInArrow(_count, "fk long, pk long, n long").groupBy("fk", "pk").agg(F.sum("n").alias("matched")))
    part = lambda c: (F.shiftright(c, ORDINAL_BITS).cast("int"), F.col(c).bitwiseAND(F.lit((1 << ORDINAL_BITS) - 1)).cast("int"))
    (fd, fo), (pd_, po) = part("fk"), part("pk")
    return (sums.select(fd.alias("fk_dataset"), fo.alias("fk_ordinal"), pd_.alias("pk_dataset"), po.alias("pk_ordinal"),
                        "matched").filter("fk_dataset <> pk_dataset"))
