"""Conversation structure repair: cheapest edits, then the least audit among them.

A conversation's rows, in order of turn, become ``(s?(ua)+)?`` of role initials
by edits of a cost: Keep 0, Rerole to user or assistant 1, Delete 2 (required
for blank and repeated rows), Insert an empty user or assistant turn 5; a
truncated row that is not deleted adds 5.

Nodes are (rows read, state), the states being nothing yet, after s, after u and
after a; arcs are the edits.

1. A cost DP from the end gives each node the least cost to go.  An arc on which
   the cost adds up is optimal.
2. Prefix-doubling path ranking: nodes are ranked by the least audit of length
   1, 2, 4, ... that leaves them over optimal arcs.  Two arcs of a node never
   share an initial (the state names the only role that may come next), so the
   least audit of 2**k leaves a node along one path, whose end is the node's
   k-th pointer; ranks of 2**(k+1) order pairs (own rank, rank at the pointer),
   and pointers are doubled.
3. At each node the optimal arc of the least (initial, rank of its end) is
   taken; the doubled pointers of these arcs list the path's nodes.

Many conversations go through one numpy pass; of a long one, blocks of rows do,
from the last to the first for the costs and from the first to the last for the
path, so a task holds a byte for each of its rows and one block's nodes.

On Spark: the damaged rows are range-partitioned by (conversation, turn, role,
text), so a conversation of any size spreads; what leaves that shuffle is a few
bytes a row (initial, fault, a digest of role and text).  Repeated rows are
found by grouping on the digest, then the codes meet their conversation.  The
edits and the texts meet in one sorted stream, where the repaired text is hashed
without being held.

Rows that share a turn are ordered by role and text.

Defined cases: a null role or text is one space, as is a null conv_id or turn in
the checksum that picks the damage; null conv_ids are one conversation; null
turns come first; a conversation that loses all rows has zeros, an empty audit
and the hash of the empty string; empty tables give empty results; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellrisk.llm.common import NO_ID, join_hot, null_id, stored

BLANKS = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Initials of the edits in ASCII order; a node's least audit is ranked by these places, 0 is the end.
INITIALS = np.frombuffer(b" DIKR", np.uint8)
#: States: nothing yet, after s, after u, after a.  The state that a role of one's choice leads to.
GOES = np.array([2, 2, 3, 2])
ROLE = ("user", "user", "assistant", "user")
FAR = 1 << 40
#: Codes of a row: 4 * fault + initial.  Initials: other, s, u, a; faults: none, truncated, blank, duplicate.
FAULTS = ("none", "truncated", "blank", "duplicate")
#: Stands before a shorter conversation's rows in a block.
NOTHING = 255
BLOCK_ROWS = 1 << 14
#: state x initial -> state after Keep, -1 where the role does not fit.
FITS = np.array([[-1, 1, 2, -1], [-1, -1, 2, -1], [-1, -1, -1, 3], [-1, -1, 2, -1]])


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage that crc32(conv_id:turn) % 20 picks."""
    c = F.col
    blank = F.lit(" ")
    rows = conversations.select(c("conv_id").cast("long").alias("conv_id"), c("turn").cast("long").alias("turn"),
                                F.coalesce(c("role").cast("string"), blank).alias("role"), F.coalesce(c("text").cast("string"), blank).alias("text"))
    key = F.concat(F.coalesce(c("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(c("turn").cast("string"), blank))
    rows = rows.withColumn("damage", F.crc32(key) % 20).where("damage <> 0")
    text = F.when(c("damage") == 1, F.lit("")).when(c("damage") == 2, F.translate("text", ".!?", "")).otherwise(c("text"))
    role = F.when(c("damage") == 4, F.lit("user")).otherwise(c("role"))
    times = F.explode(F.when(c("damage") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("again")).drop("again")


def _codes(rows: DataFrame) -> DataFrame:
    """(conv_id, at, turn, code, blank) of each row, without its text; ``at`` grows with the row's place."""
    c = F.col
    rows = rows.withColumns({"conv_id": F.coalesce("conv_id", F.lit(NO_ID)), "row": F.monotonically_increasing_id()})
    keys = ["conv_id", "turn", "role", "text", "row"]  # the last, so that rows that repeat spread too
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    bare = F.rtrim("text", F.lit(BLANKS))
    fault = F.when(bare == "", 2).when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), 1).otherwise(0)
    first = F.left("role", F.lit(1))
    initial = F.when(first == "s", 1).when(first == "u", 2).when(first == "a", 3).otherwise(0)
    same = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), c("role"), c("text")), 256))
    codes = stored(ordered.select("conv_id", F.monotonically_increasing_id().alias("at"), "turn", (fault * 4 + initial).cast("int").alias("code"), same.alias("same")), "codes")
    groups = stored(codes.groupBy("conv_id", "same").agg(F.min("at").alias("first"), F.count("*").alias("times")).where("times > 1"), "repeats")
    marked = join_hot(codes, groups, ["conv_id", "same"], "times", "left")
    repeated = (c("code") < 8) & (c("at") > F.coalesce("first", c("at")))
    return marked.select("conv_id", "at", "turn", F.when(repeated, c("code") % 4 + 12).otherwise(c("code")).cast("int").alias("code"))


# the DP over blocks -----------------------------------------------------------

def _with_inserts(f: np.ndarray) -> np.ndarray:
    """Costs to go (..., 4) after any insertions."""
    for _ in range(2):
        f = np.minimum(f, INSERT + f[..., GOES])
    return f


def _row_costs(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keep, rerole) costs by state, and the state after keeping, for codes (m,)."""
    fault, initial = code // 4, code % 4
    stays = np.where(fault >= 2, FAR, np.where(fault == 1, TRUNCATED, 0))[:, None]
    to = FITS[:, initial].T
    return np.where(to >= 0, stays + KEEP, FAR), np.broadcast_to(stays + REROLE, to.shape), np.maximum(to, 0)


def costs_to_go(codes: np.ndarray, end: np.ndarray, last: bool) -> np.ndarray:
    """(rows + 1, m, 4) of right-aligned codes (m, rows); ``end`` (m, 4) is what
    the rows after the block cost, or 0 and FAR at a conversation's end, where
    insertions are still possible."""
    m, n = codes.shape
    f = np.empty((n + 1, m, 4), np.int64)
    f[n] = _with_inserts(end) if last else end
    for i in range(n - 1, -1, -1):
        code, after = codes[:, i], f[i + 1]
        real = code != NOTHING
        keep, rerole, to = _row_costs(np.where(real, code, 0))
        g = np.minimum(np.minimum(after + DELETE, np.take_along_axis(after, to, 1) + keep), after[:, GOES] + rerole)
        f[i] = np.where(real[:, None], _with_inserts(g), after)
    return f


def _arcs(codes: np.ndarray, f: np.ndarray, end: np.ndarray, last: bool) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(place of the initial, is the arc optimal, node it ends in) by edit; nodes are (layer, m, state)."""
    n, m = codes.shape[1], codes.shape[0]
    node = np.arange((n + 1) * m * 4).reshape(n + 1, m, 4)
    code = np.vstack([codes.T, np.full((1, m), NOTHING, codes.dtype)])  # (layer, m): no row at the last
    real = (code != NOTHING)[:, :, None]
    flat = np.where(code == NOTHING, 0, code).ravel()
    keep, rerole, to = (x.reshape(n + 1, m, 4) for x in _row_costs(flat))
    after = np.concatenate([f[1:], np.full((1, m, 4), FAR)])
    below = np.concatenate([node[1:], node[-1:]])
    done = np.zeros((n + 1, m, 4), bool)
    done[n] = f[n] == end if last else True
    inserts = np.ones((n + 1, 1, 1), bool)
    inserts[n] = last
    reachable = (f < FAR) & ~done
    return [(1, reachable & real & (f == after + DELETE), below),
            (2, reachable & inserts & (real | (np.arange(n + 1) == n)[:, None, None]) & (f == f[..., GOES] + INSERT), node[..., GOES]),
            (3, reachable & real & (f == np.take_along_axis(after, to, 2) + keep), np.take_along_axis(below, to, 2)),
            (4, reachable & real & (f == after[..., GOES] + rerole), below[..., GOES])]


def least_paths(codes: np.ndarray, f: np.ndarray, end: np.ndarray, last: bool, start: np.ndarray) -> list[tuple[bytes, int]]:
    """(audit, state at the end) of the least optimal path from each node of ``start``."""
    arcs = _arcs(codes, f, end, last)
    size = f.size
    own = np.arange(size)
    letter, jump = np.zeros(size, np.int64), own.copy()
    for place, ok, ends in reversed(arcs):  # the least initial last
        ok = ok.ravel()
        letter[ok], jump[ok] = place, ends.ravel()[ok]
    rank, pointer, length = letter, jump, 1
    most = 2 * codes.shape[1] + 4
    while length < most:
        pair = rank * (int(rank.max()) + 1) + rank[pointer]
        kinds, ranks = np.unique(pair, return_inverse=True)
        rank, pointer, length = ranks.astype(np.int64), pointer[pointer], 2 * length
        if len(kinds) == size:
            break  # all audits differ
    # of a node's optimal arcs the one of the least initial and rank
    best = np.full(size, np.iinfo(np.int64).max)
    for place, ok, ends in arcs:
        ok, ends = ok.ravel(), ends.ravel()
        key = np.where(ok, place * (int(rank.max()) + 1) + rank[ends], best)
        better = key < best
        best[better], letter[better], jump[better] = key[better], place, ends[better]
    path, pointer = start[:, None], jump
    while (letter[path[:, -1]] > 0).any():
        path = np.hstack([path, pointer[path]])
        pointer = pointer[pointer]
    out = []
    for p in path:
        a = letter[p]
        k = int(np.argmax(a == 0))
        out.append((INITIALS[a[:k]].tobytes(), int(p[k] % 4)))
    return out


ACCEPTS = np.array([0, FAR, FAR, 0], np.int64)


def repair_many(conversations: list[np.ndarray]) -> list[tuple[int, bytes]]:
    """(cost, audit) of conversations given as codes of their rows."""
    out: list = [None] * len(conversations)
    order = sorted(range(len(conversations)), key=lambda i: len(conversations[i]))
    while order:
        n = len(conversations[order[-1]])
        if n > BLOCK_ROWS:
            i = order.pop()
            out[i] = repair_long(conversations[i])
            continue
        now = [order.pop() for _ in range(min(len(order), max(1, 2 * BLOCK_ROWS // max(1, n))))]
        codes = np.full((len(now), n), NOTHING, np.uint8)
        for j, i in enumerate(now):
            codes[j, n - len(conversations[i]):] = conversations[i]
        end = np.broadcast_to(ACCEPTS, (len(now), 4))
        f = costs_to_go(codes, end, True)
        # a shorter conversation starts at its first row's layer
        layer = n - np.array([len(conversations[i]) for i in now])
        start = layer * len(now) * 4 + np.arange(len(now)) * 4
        for i, j, (audit, _) in zip(now, range(len(now)), least_paths(codes, f, end, True, start)):
            out[i] = int(f[layer[j], j, 0]), audit
    return out


def repair_long(codes: np.ndarray, block: int = BLOCK_ROWS) -> tuple[int, bytes]:
    """The same for one conversation, block by block."""
    cut = list(range(0, len(codes), block))
    ends = [ACCEPTS[None]]
    for i in reversed(cut):
        last = i == cut[-1]
        ends.append(costs_to_go(codes[None, i:i + block], ends[-1], last)[0])
    cost, state, audit = int(ends.pop()[0, 0]), 0, []
    for i in cut:
        part, end, last = codes[None, i:i + block], ends.pop(), i == cut[-1]
        (text, state), = least_paths(part, costs_to_go(part, end, last), end, last, np.array([state]))
        audit.append(text)
    return cost, b"".join(audit)


# on Spark -----------------------------------------------------------------------

_REPAIRS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class _Conversation:
    """What is held of one conversation while its codes stream by."""

    def __init__(self, conv: int):
        self.conv, self.codes, self.illegal, self.initial = conv, [], 0, -1
        self.low = self.high = self.turn = None
        self.turns = 0

    def add(self, code: np.ndarray, turn: np.ndarray) -> None:
        """Codes in order, and their turns without nulls."""
        self.codes.append(code.astype(np.uint8))
        x = np.r_[self.initial, code % 4] if self.initial >= 0 else code % 4
        pair = x[:-1] * 4 + x[1:]
        self.illegal += int((~np.isin(pair, (1 * 4 + 2, 2 * 4 + 3, 3 * 4 + 2))).sum())
        self.initial = int(x[-1])
        if len(turn):
            self.low = int(turn[0]) if self.low is None else self.low
            self.turns += int((turn[1:] != turn[:-1]).sum()) + (self.turn != int(turn[0]))
            self.high = self.turn = int(turn[-1])

    def done(self) -> tuple[np.ndarray, list[int]]:
        codes = np.concatenate(self.codes) if self.codes else np.zeros(0, np.uint8)
        fault = np.bincount(codes // 4, minlength=4)
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return codes, [gaps, int(fault[2]), int(fault[3]), int(fault[1]), self.illegal]


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[_Conversation] = []
    rows = 0

    def flush(some: list[_Conversation]) -> pa.RecordBatch:
        codes, counts = zip(*(x.done() for x in some))
        repaired = repair_many(list(codes))
        columns = [[x.conv for x in some], *zip(*counts), [c for c, _ in repaired]]
        return pa.RecordBatch.from_arrays([*(pa.array(list(x), pa.int64()) for x in columns), pa.array([a.decode() for _, a in repaired], pa.string())], ["conv_id", *_COUNTS, "audit"])

    for b in batches:
        conv, code = (b.column(c).to_numpy(zero_copy_only=False) for c in ("conv_id", "code"))
        turn = b.column("turn")
        known = ~turn.is_null().to_numpy(zero_copy_only=False)
        turn = turn.fill_null(0).to_numpy()
        cut = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]][:len(conv)])
        for i, j in zip(cut, [*cut[1:], len(conv)]):
            if not held or held[-1].conv != conv[i]:
                if rows >= 1 << 16:
                    yield flush(held)
                    held, rows = [], 0
                held.append(_Conversation(int(conv[i])))
            real = code[i:j] >= 0  # the marker of a conversation is no row
            if real.any():
                held[-1].add(code[i:j][real], turn[i:j][real & known[i:j]])
            rows += int(j - i)
    if held:
        yield flush(held)


def repairs(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every
    conversation, damaged as ``damaged`` says; a null conv_id is NO_ID."""
    every = conversations.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("conv_id")).distinct()
    markers = every.select("conv_id", F.lit(-1).cast("long").alias("at"), F.lit(None).cast("long").alias("turn"), F.lit(-1).alias("code"))
    return (_codes(damaged(conversations)).union(markers).repartition("conv_id").sortWithinPartitions("conv_id", "at").mapInArrow(_repair, _REPAIRS))


def edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """(role, text) of the repaired conversation: ``rows`` under the audit's edits."""
    state = 0
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit == "K":
            state = int(FITS[state, "?sua".find(role[:1])])
        else:
            role, state = ROLE[state], int(GOES[state])
        yield role, text


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation, its repair before its turns."""
    def rows():
        for b in batches:
            yield from zip(*(b.column(c).to_pylist() for c in ("conv_id", "kind", "role", "text", "counts")))

    stream, names = rows(), ["conv_id", *_COUNTS, "audit", "repaired_sha256"]
    out, head = [], next(stream, None)

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(pa.array([r[i] for r in out], pa.int64()) for i in range(7)), *(pa.array([r[i] for r in out], pa.string()) for i in (7, 8))], names)

    while head is not None:
        conv, _, _, audit, counts = head
        head = None

        def turns():
            """Up to the next conversation's repair, which becomes the head."""
            nonlocal head
            for row in stream:
                if row[1] == 0:
                    head = row
                    return
                yield row[2], row[3]

        own, sha, first = turns(), hashlib.sha256(), True
        for role, text in edited(audit, own):
            sha.update(f"{'' if first else chr(10)}{role}:{text}".encode())
            first = False
        for _ in own:  # a conversation's rows end where its audit does
            raise ValueError(f"conversation {conv} has more rows than edits")
        out.append((conv, *counts, audit, sha.hexdigest()))
        if len(out) >= 5000:
            yield batch()
            out = []
    yield batch()


def repair_digests(conversations: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, the counts, cost, audit, repaired_sha256."""
    fixed = stored(repairs(conversations), "repairs")
    heads = fixed.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), F.array(*_COUNTS).alias("counts"))
    turns = damaged(conversations).select(F.coalesce("conv_id", F.lit(NO_ID)).alias("conv_id"), F.lit(1).alias("kind"), "turn", "role", "text", F.lit(None).cast("array<long>").alias("counts"))
    schema = "conv_id long, " + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string, repaired_sha256 string"
    done = heads.union(turns).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "text").mapInArrow(_digest, schema)
    return done.select(null_id("conv_id"), *_COUNTS, "audit", "repaired_sha256")
