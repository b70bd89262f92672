"""Packing into batches by optimal length buckets.

A global histogram of lengths goes to the driver, one row for each length there is: n different lengths need texts of
n * n / 2 words in all, so a million of them stand for half a trillion words. Dynamic programming over it chooses the
bucket boundaries that minimise padding over all documents. Inside a bucket, batches of a fixed token budget take documents in a fixed order.
"""

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logweir.llm.tables import word_list, written

BUCKETS = 16
TOKEN_BUDGET = 65_536
#: Rows numbered by one task.
RUN = 100_000


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Boundaries, ascending, of at most ``buckets`` buckets that minimise the padding of ``counts`` documents.

    ``lengths`` ascend. A bucket's documents are padded to its boundary, the longest length in it. best[j] is the
    least total of boundary times documents for the first j lengths; each further bucket is one step of the
    programme. A last bucket that begins behind length i costs best[i] - length_j * before[i], and length_j * before[j]
    whatever i is: that is a line for each i, and the lengths ask for the lowest line at ever larger places. So a step
    looks at each line a fixed number of times. Of equal totals the fewest and the shortest first buckets win.
    """
    m = len(lengths)
    if m == 0:
        return []
    longest = [int(x) for x in lengths]
    # Whole numbers, as totals may pass what a float tells apart.
    before = [0, *np.cumsum(counts).tolist()]
    best: list[int | None] = [0] + [None] * m
    steps = []
    for _ in range(min(buckets, m)):
        nxt: list[int | None] = [None] * (m + 1)
        frm = [0] * (m + 1)
        lines: list[int] = []
        at = 0
        for j in range(1, m + 1):
            new = best[j - 1]
            if new is not None:
                while len(lines) - at > 1 and _hidden(best, before, lines[-2], lines[-1], j - 1):
                    lines.pop()
                lines.append(j - 1)
            if not lines:
                continue
            x = longest[j - 1]
            while at + 1 < len(lines) and best[lines[at + 1]] - x * before[lines[at + 1]] < best[lines[at]] - x * before[lines[at]]:
                at += 1
            frm[j] = lines[at]
            nxt[j] = best[frm[j]] + x * (before[j] - before[frm[j]])
        steps.append((nxt[m], frm))
        best = nxt
    k = min((total, i) for i, (total, _) in enumerate(steps) if total is not None)[1]
    out, j = [], m
    for _, frm in steps[k::-1]:
        out.append(longest[j - 1])
        j = frm[j]
    return out[::-1]


def _hidden(best: list, before: list[int], a: int, b: int, c: int) -> bool:
    """Whether line b is nowhere below both its neighbours a and c, their slopes falling from a to c."""
    return (best[c] - best[a]) * (before[b] - before[a]) <= (best[b] - best[a]) * (before[c] - before[a])


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length_col: str | None = None,
    buckets: int = BUCKETS,
    token_budget: int = TOKEN_BUDGET,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_tokens``, ``bucket``, ``padded_to``, ``batch``, ``slot``.

    ``n_tokens`` is ``length_col`` if named, else the number of words of the text; null counts as 0, and so does a
    negative length. A bucket pads to its boundary, so a batch of it has ``token_budget // padded_to`` documents,
    one at least: a document above the budget is alone. Documents of length 0 are in bucket 0, which is padded to
    0 and batched like lengths of 1. Within a bucket documents are taken by a hash of their id, then by id, null
    ids first; rows that tie in both are numbered in any order. Batches are numbered from 0 in each bucket and only
    the last one of a bucket may be short. An empty table gives no rows; other columns are ignored.

    No task numbers a whole bucket: rows are numbered within runs of the hash, and offsets of runs come from a table
    of their sizes.
    """
    length = F.col(length_col) if length_col else F.size(word_list(F.col(text_col)))
    rows = docs.select(
        F.col(id_col).alias("id"), F.greatest(F.coalesce(length, F.lit(0)), F.lit(0)).cast("long").alias("n_tokens")
    )
    rows = written(rows, "pack-lengths")
    histogram = rows.groupBy(F.col("n_tokens").alias("length")).agg(F.count("*").alias("n"))
    counted = sorted((r.length, r.n) for r in histogram.collect())
    some = [(k, n) for k, n in counted if k > 0]
    bounds = best_boundaries(np.array([k for k, _ in some]), np.array([n for _, n in some]), buckets)

    # Only boundaries matter from here on; a length is in the first bucket that holds it.
    bucket = F.lit(len(bounds))
    for k in range(len(bounds) - 1, -1, -1):
        bucket = F.when(F.col("n_tokens") <= bounds[k], F.lit(k + 1)).otherwise(bucket)
    bucket = F.when(F.col("n_tokens") == 0, F.lit(0)).otherwise(bucket)
    padded = F.get(F.array(F.lit(0).cast("long"), *(F.lit(b).cast("long") for b in bounds)), F.col("bucket"))
    # Runs cut the range of the hash evenly, in proportion to the documents there are.
    runs = max(1, -(-sum(n for _, n in counted) // RUN))
    place = F.col("place")
    placed = rows.withColumn("bucket", bucket).withColumn("place", F.pmod(F.xxhash64("id"), F.lit(1 << 30)))
    placed = placed.withColumn("run", F.floor(place * runs / (1 << 30)).cast("int"))
    sizes = placed.groupBy("bucket", "run").agg(F.count("*").alias("size"))
    # One row for each bucket and run.
    earlier = F.sum("size").over(Window.partitionBy("bucket").orderBy("run").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("bucket", "run", F.coalesce(earlier, F.lit(0)).alias("offset"))
    number = F.row_number().over(Window.partitionBy("bucket", "run").orderBy("place", "id")) - 1
    numbered = placed.withColumn("number", number).join(offsets, ["bucket", "run"])
    capacity = F.greatest(F.floor(F.lit(token_budget) / F.greatest("padded_to", F.lit(1))), F.lit(1)).cast("long")
    numbered = numbered.withColumn("padded_to", padded).withColumn("at", F.col("offset") + F.col("number"))
    numbered = numbered.withColumn("capacity", capacity)
    return numbered.select(
        F.col("id").alias(id_col),
        "n_tokens",
        "bucket",
        "padded_to",
        F.floor(F.col("at") / F.col("capacity")).cast("long").alias("batch"),
        F.pmod("at", "capacity").cast("long").alias("slot"),
    )
