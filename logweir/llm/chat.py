"""Chat formatting by minimum-cost role repair.

A conversation is legal if it is an optional system turn, then user and assistant turns that alternate, an assistant
turn last. For each turn the repair may keep its role, relabel it, merge it into the turn before if both have one
role, and insert empty turns before it; dynamic programming over the states of the automaton finds the cheapest way.

What a run of turns does to a state is a small min-plus matrix, and matrices of neighbouring runs combine
associatively. So no task needs a whole conversation: rows are sorted over all tasks by conversation and turn, cut
into fragments of bounded size, each gives a matrix, matrices of one conversation give each fragment the state it
begins and ends in, and each fragment is then traced back alone. Rendering is by row: pieces in order make the text.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.llm.tables import written

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
#: Legal next states.
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
FINAL = ASSISTANT
MERGE, INSERT, RELABEL = 1, 2, 3
FAR = 1 << 40
FRAGMENT = 1 << 14
TAIL = "<|end|>\n"


# --- the automaton -------------------------------------------------------------------------------------------------


def _insertions() -> dict[tuple[int, int], tuple[int, ...]]:
    """For each pair of states the fewest empty turns that lead from one to the other."""
    found = {(s, s): () for s in NEXT}
    grown = True
    while grown:
        grown = False
        for (a, b), path in list(found.items()):
            for c in NEXT[b]:
                if len(found.get((a, c), range(9))) > len(path) + 1:
                    found[a, c] = (*path, c)
                    grown = True
    return found


PATHS = _insertions()


def steps(state: int, role: int) -> Iterator[tuple[int, int, tuple[int, ...], bool]]:
    """Ways to take a turn of ``role`` (0: none of the roles): new state, cost, inserted turns, whether merged."""
    for new in (SYSTEM, USER, ASSISTANT):
        cost = 0 if new == role else RELABEL
        if new == state:
            yield new, cost + MERGE, (), True
        for middle in NEXT:
            if (state, middle) in PATHS and new in NEXT[middle]:
                path = PATHS[state, middle]
                yield new, cost + INSERT * len(path), path, False


#: The cheapest way for each state, role and new state; of equal costs a merge, then the first middle state.
BEST: dict[tuple[int, int], dict[int, tuple[int, tuple[int, ...], bool]]] = {}
for _s in NEXT:
    for _r in range(4):
        for _new, _cost, _path, _merged in steps(_s, _r):
            _ways = BEST.setdefault((_s, _r), {})
            if _new not in _ways or _cost < _ways[_new][0]:
                _ways[_new] = (_cost, _path, _merged)
#: What it costs to end in each state.
ENDS = [INSERT * len(PATHS[s, FINAL]) if s != START else 0 for s in NEXT]

IDENTITY = [0 if i == j else FAR for i in range(4) for j in range(4)]


def combine(a: list[int], b: list[int]) -> list[int]:
    """Min-plus product of two matrices given row by row."""
    return [min(FAR, *(a[4 * i + k] + b[4 * k + j] for k in range(4))) for i in range(4) for j in range(4)]


TURNS = [
    [BEST[s, r][t][0] if t in BEST[s, r] else FAR for s in range(4) for t in range(4)] for r in range(4)
]


def matrix(roles: list[int]) -> list[int]:
    out = IDENTITY
    for r in roles:
        out = combine(out, TURNS[r])
    return out


def trace(roles: list[int], enter: int, leave: int) -> list[tuple[int, tuple[int, ...], bool]]:
    """New state, inserted turns and merge of each turn on the cheapest way from ``enter`` to ``leave``."""
    cost = [FAR] * 4
    cost[enter] = 0
    came: list[list[int]] = []
    for r in roles:
        now, frm = [FAR] * 4, [0] * 4
        for s in range(4):
            for t, (c, _, _) in BEST[s, r].items():
                if cost[s] + c < now[t]:
                    now[t], frm[t] = cost[s] + c, s
        came.append(frm)
        cost = now
    out, t = [], leave
    for r, frm in zip(reversed(roles), reversed(came), strict=True):
        s = frm[t]
        out.append((t, *BEST[s, r][t][1:]))
        t = s
    return out[::-1]


def stitch(matrices: list[list[int]]) -> tuple[int, list[tuple[int, int]]]:
    """Cost of a conversation, and the states in which each of its fragments begins and ends."""
    sums = [[0, FAR, FAR, FAR]]
    for m in matrices:
        sums.append([min(sums[-1][s] + m[4 * s + t] for s in range(4)) for t in range(4)])
    total, t = min((sums[-1][s] + ENDS[s], s) for s in range(4))
    ways = []
    for m, before in zip(reversed(matrices), reversed(sums[:-1]), strict=True):
        s = min(range(4), key=lambda s: (before[s] + m[4 * s + t], s))
        ways.append((s, t))
        t = s
    return total, ways[::-1]


# --- tasks -------------------------------------------------------------------------------------------------------------


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [matrix([t["role"] for t in turns]) for turns in batch.column("turns").to_pylist()]
        yield batch.select(["conv", "fragment"]).append_column("matrix", pa.array(made, pa.list_(pa.int64())))


def _stitcher(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for fragments in batch.column("fragments").to_pylist():
            total, ways = stitch([f["matrix"] for f in fragments])
            last = len(ways) - 1
            rows += [(f["fragment"], s, t, k == last, total) for k, (f, (s, t)) in enumerate(zip(fragments, ways, strict=True))]
        names = ("fragment", "enter", "leave", "is_last", "cost")
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64())
        yield pa.record_batch({n: pa.array([r[i] for r in rows], k) for i, (n, k) in enumerate(zip(names, kinds, strict=True))})


def _tracer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for f in batch.to_pylist():
            state = f["enter"]
            for k, (turn, (new, path, merged)) in enumerate(
                zip(f["turns"], trace([t["role"] for t in f["turns"]], f["enter"], f["leave"]), strict=True)
            ):
                ends = f["is_last"] and k == len(f["turns"]) - 1
                after = PATHS[new, FINAL] if ends else ()
                rows.append((turn["pos"], new, list(path), merged, state != START, ends, list(after), f["cost"]))
                state = new
        kind = pa.list_(pa.int32())
        names = ("pos", "state", "before", "merged", "opened", "ends", "after", "cost")
        kinds = (pa.int64(), pa.int32(), kind, pa.bool_(), pa.bool_(), pa.bool_(), kind, pa.int64())
        yield pa.record_batch({n: pa.array([r[i] for r in rows], k) for i, (n, k) in enumerate(zip(names, kinds, strict=True))})


# --- the whole operator ---------------------------------------------------------------------------------------------------


def _role_name(state: Column) -> Column:
    return F.get(F.array(*map(F.lit, ROLES)), state - 1)


def _head(state: Column) -> Column:
    return F.concat(F.lit("<|"), _role_name(state), F.lit("|>\n"))


def _empty_turns(states: Column) -> Column:
    turn = lambda s: F.concat(_head(s), F.lit(TAIL))
    return F.array_join(F.transform(states, turn), "")


def format_chats(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``turns``: conv, turn, role and text, and what the repair makes of it.

    ``position`` orders all rows, by conversation and turn. ``new_role`` is the role after repair; ``action`` is
    keep, relabel, merge or relabel and merge; ``inserted`` names empty turns put before the turn and ``closing``
    those put behind the last one; ``cost`` is that of the whole conversation and the least possible. ``rendered``
    is the turn's piece of the text: pieces of a conversation in order of position make the whole.

    Roles are compared without case and blanks; a null or other role must be relabelled. Null texts are empty. Turns
    with one number are ordered by role, then text; null numbers and roles come first. A null conversation id is
    an id like any other. Repeated rows are turns of their own (and mostly merged). Among ways of equal cost the
    choice is fixed by the order of states. An empty table gives no rows; other columns are ignored.
    """
    rows = turns.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.col(role_col).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    code = F.array_position(F.array(*map(F.lit, ROLES)), F.lower(F.trim(F.coalesce("role", F.lit("")))))
    rows = rows.withColumns({"code": code.cast("int"), "tie": F.xxhash64("text")})
    order = ("conv", "turn", "role", "tie", "text")
    # Long texts take no part in the ranges, only in the order within them.
    ranged = rows.repartitionByRange(*order[:4]).sortWithinPartitions(*order)
    placed = written(ranged.withColumn("pos", F.monotonically_increasing_id()).drop("tie"), "chat-turns")

    # A position is the task's number and the row's number within the task; the latter is cut into fragments.
    cut = F.floor(F.col("pos") / FRAGMENT).alias("cut")
    pieces = placed.groupBy("conv", cut).agg(
        F.min("pos").alias("fragment"),
        F.sort_array(F.collect_list(F.struct("pos", F.col("code").alias("role")))).alias("turns"),
    )
    pieces = written(pieces.select("conv", "fragment", "turns"), "chat-fragments")
    made = pieces.mapInArrow(_matrices, pieces.select("conv", "fragment").withColumn("matrix", F.array(F.lit(0).cast("long"))).schema)
    whole = made.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("fragment", "matrix"))).alias("fragments"))
    states = whole.select("fragments").mapInArrow(
        _stitcher, "fragment long, enter int, leave int, is_last boolean, cost long"
    )
    traced = pieces.select("fragment", "turns").join(states, "fragment").mapInArrow(
        _tracer,
        "pos long, state int, before array<int>, merged boolean, opened boolean, ends boolean, after array<int>, cost long",
    )
    both = placed.join(traced, "pos")
    changed = F.col("state") != F.col("code")
    action = (
        F.when(F.col("merged") & changed, "relabel and merge")
        .when(F.col("merged"), "merge")
        .when(changed, "relabel")
        .otherwise("keep")
    )
    before = F.concat(F.when(F.col("opened"), TAIL).otherwise(""), _empty_turns(F.col("before")))
    close = F.when(F.col("ends"), F.concat(F.lit(TAIL), _empty_turns(F.col("after")))).otherwise("")
    rendered = F.concat(F.when(F.col("merged"), "\n").otherwise(F.concat(before, _head(F.col("state")))), "text", close)
    names = lambda c: F.array_join(F.transform(c, _role_name), ",")
    return both.select(
        F.col("conv").alias(conv_col),
        F.col("turn").alias(turn_col),
        F.col("role").alias(role_col),
        F.col("pos").alias("position"),
        _role_name(F.col("state")).alias("new_role"),
        action.alias("action"),
        names(F.col("before")).alias("inserted"),
        names(F.col("after")).alias("closing"),
        "cost",
        rendered.alias("rendered"),
    )
