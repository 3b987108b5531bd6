"""Conversation structure repair: the cheapest edits that give each conversation the roles ``(s?(ua)+)?``.

Each conversation becomes a signature, one character for each row: ``x`` for a row that has to go (blank or
duplicate), else the initial of its role, in upper case if the row is truncated (``o``, ``O`` for other roles). All
different signatures are sorted from their ends, over range partitions, so that signatures with a common suffix are
neighbours and share its nodes: a suffix-shared automaton (DAWG) minimised from the end. A node is a distinct
suffix; its cost-to-go and the first edit of its best audit are computed once for each of the four grammar states,
for all conversations that end in it (again only where a range begins). From one state each kind of edit leads to
one state, so among edits of equal cost the ASCII-least letter decides and an audit is read off node by node.

Spark does the rest: faults as expressions, duplicates by a window over digests, one shuffle of slim rows by
conversation for signatures, a join by signature (a hot one is split by the skew join), and one shuffle of the
texts, in which the audit of a conversation goes before its rows, so repaired rows are streamed and never gathered.

Defined results: null role and text are one space, as are nulls in the damage key; rows with a null conv_id are one
conversation; rows of one turn are taken by role, then by the digest of their text; a conversation without rows
after damage has zeros, an empty audit and the hash of the empty string; a number of gaps beyond 64 bits is the
largest long; an empty table gives an empty one; other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, cut

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"

# grammar states: nothing yet, after s, after u, after a; what u, a and s lead to, None where not allowed
NEXT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
ACCEPTS = (True, False, False, True)
TURN = (("u", 2), ("u", 2), ("a", 3), ("u", 2))  # what a new role in each state has to be
FAR = 1 << 60


class Node:
    """A suffix of signatures: for each grammar state its cost-to-go, and the letter and state of the best first edit."""

    __slots__ = ("next", "cost", "edit", "then")

    def __init__(self, symbol: str, after: "Node | None"):
        self.next, self.cost, self.edit, self.then = after, [FAR] * 4, [""] * 4, [0] * 4
        role, fee = symbol.lower(), TRUNCATED if symbol.isupper() else 0
        for q in range(4):
            if after is None:
                if ACCEPTS[q]:
                    self.cost[q] = 0
                continue
            self._offer(q, DELETE + after.cost[q], "D", q)
            if symbol != "x":
                if role in NEXT and NEXT[role][q] is not None:
                    self._offer(q, KEEP + fee + after.cost[NEXT[role][q]], "K", NEXT[role][q])
                self._offer(q, REROLE + fee + after.cost[TURN[q][1]], "R", TURN[q][1])
        for _ in range(3):  # an insertion leads to another state of the same node, never usefully round
            for q in range(4):
                self._offer(q, INSERT + self.cost[TURN[q][1]], "I", TURN[q][1])

    def _offer(self, q: int, cost: int, letter: str, then: int) -> None:
        if cost < self.cost[q] or cost == self.cost[q] and letter < self.edit[q]:
            self.cost[q], self.edit[q], self.then[q] = cost, letter, then

    def audit(self) -> str:
        out, node, q = [], self, 0
        while node.edit[q]:
            letter = node.edit[q]
            out.append(letter)
            q = node.then[q]
            if letter != "I":
                node = node.next
        return "".join(out)


def _common(a: str, b: str) -> int:
    """Length of the common suffix."""
    n = min(len(a), len(b))
    lo = 0
    while lo < n:  # by halves: equal tails are compared by the interpreter's own memory comparison
        mid = (lo + n + 1) // 2
        if a[len(a) - mid:] == b[len(b) - mid:]:
            lo = mid
        else:
            n = mid - 1
    return lo


def _best_edits(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signatures sorted from their ends: the path of the last one is kept, its common suffix with the next one is shared."""
    path, last = [Node("", None)], ""
    for b in batches(it):
        costs, audits = [], []
        for signature in b.column(0).to_pylist():
            del path[_common(last, signature) + 1:]
            for symbol in reversed(signature[:len(signature) - len(path) + 1]):
                path.append(Node(symbol, path[-1]))
            last = signature
            costs.append(path[-1].cost[0])
            audits.append(path[-1].audit())
        yield pa.RecordBatch.from_pydict({"signature": b.column(0), "cost": pa.array(costs, pa.int64()), "audit": pa.array(audits, pa.string())})


def best_edits(signatures: DataFrame) -> DataFrame:
    """(signature, cost, audit) of each different value of the column ``signature``."""
    each = signatures.select("signature").distinct()
    return (each.withColumn("_from_end", F.reverse("signature")).repartitionByRange("_from_end").sortWithinPartitions("_from_end")
            .select("signature").mapInArrow(_best_edits, "signature string, cost long, audit string"))


# --- rows

def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copy) after damage by crc32(``conv_id:turn``) % 20; ``copy`` is null for a dropped row."""
    as_text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                       (F.crc32(F.concat_ws(":", *as_text)) % 20).alias("fate"))
    fate = F.col("fate")
    copies = F.when(fate == 0, F.array(F.lit(None).cast("int"))).when(fate == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", F.when(fate == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                       F.when(fate == 1, F.lit("")).when(fate == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
                       F.explode(copies).alias("copy"))


def _ordered(rows: DataFrame) -> DataFrame:
    """Adds the digest that settles the order of rows of one turn."""
    return rows.withColumn("digest", F.unhex(F.md5("text")))


def signatures(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, signature), a row for each conversation of ``damage``'s rows."""
    body = F.rtrim("text", F.lit(WHITE))
    slim = _ordered(rows).select("conv_id", "turn", "role", "digest", "copy", (body == "").alias("blank"),
                                 (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("truncated"))
    # rows alike in conversation, role and text: all but the first are duplicates
    alike = Window.partitionBy("conv_id", "role", "digest", F.col("copy").isNull()).orderBy(F.asc_nulls_first("turn"), "copy")
    fault = (F.when(F.col("copy").isNull(), "").when(F.col("blank"), "b").when(F.col("nth") > 1, "d")
             .when(F.col("truncated"), "t").otherwise("-"))
    faulty = slim.withColumn("nth", F.row_number().over(alike)).withColumn("fault", fault)
    id_type = rows.schema["conv_id"].dataType.simpleString()
    return (faulty.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "digest", "nth")
            .select("conv_id", F.col("turn").cast("long").alias("turn"), F.substring("role", 1, 1).alias("initial"), "fault")
            .mapInArrow(_signatures, f"conv_id {id_type}, gaps long, blank long, duplicate long, truncated long, illegal long, signature string"))


_LEGAL = {"su", "ua", "au"}


def _signatures(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "signature")
    types = (None, *[pa.int64()] * 5, pa.string())
    done: list[tuple] = []
    now: dict | None = None

    def end() -> None:
        gaps = now["last"] - now["first"] + 1 - now["turns"] if now["turns"] else 0
        done.append((now["id"], min(gaps, 2**63 - 1), now["b"], now["d"], now["t"], now["illegal"], now["signature"].decode()))

    def flush(id_type: pa.DataType) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(c, t or id_type) for c, t in zip(zip(*done), types)], names)
        done.clear()
        return out

    id_type = None
    for b in batches(it, 4096):
        id_type = b.schema.field(0).type
        for conv, turn, initial, fault in zip(*(c.to_pylist() for c in b.columns)):
            if now is None or conv != now["id"]:
                if now is not None:
                    end()
                now = {"id": conv, "first": 0, "last": 0, "turns": 0, "b": 0, "d": 0, "t": 0, "illegal": 0, "before": None, "signature": bytearray()}
            if not fault:
                continue
            if turn is not None and (not now["turns"] or turn != now["last"]):
                if not now["turns"]:
                    now["first"] = turn
                now["last"] = turn
                now["turns"] += 1
            if now["before"] is not None and now["before"] + initial not in _LEGAL:
                now["illegal"] += 1
            now["before"] = initial
            symbol = initial if initial and initial in "sua" else "o"
            if fault != "-":
                now[fault] += 1
                symbol = symbol.upper() if fault == "t" else "x"
            now["signature"] += symbol.encode()
        if done:
            yield flush(id_type)
    if now is not None:
        end()
        yield flush(id_type)


_FACTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def repair(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, place, role, text): the repaired rows of each
    conversation of ``damage``'s rows, numbered from 0; one row with nulls there if none are left."""
    return _streamed(rows, _repaired, "place long, role string, text string")


def repaired_digests(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256): of ``role:text``, newline-joined."""
    return _streamed(rows, _digests, "repaired_sha256 string")


def _streamed(rows: DataFrame, task, columns: str) -> DataFrame:
    told = cut(signatures(rows), "signatures")
    edits = best_edits(told)
    heads = (told.join(edits.hint("merge"), "signature")
             .select("conv_id", F.struct(*_FACTS).alias("facts"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"),
                     F.lit("").alias("role"), F.lit("").alias("text"), F.lit(None).cast("binary").alias("digest"), F.lit(0).alias("copy")))
    body = (_ordered(rows.where(F.col("copy").isNotNull()))
            .select("conv_id", F.lit(None).cast(heads.schema["facts"].dataType).alias("facts"), F.lit(1).alias("kind"),
                    F.col("turn").cast("long").alias("turn"), "role", "text", "digest", "copy"))
    id_type = rows.schema["conv_id"].dataType.simpleString()
    return (heads.unionByName(body).repartition("conv_id")
            .sortWithinPartitions("conv_id", "kind", F.asc_nulls_first("turn"), "role", "digest", "copy")
            .select("conv_id", "kind", "facts", "role", "text")
            .mapInArrow(task, f"conv_id {id_type}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, {columns}"))


def _edited(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """("head", id, facts, type), then ("row", role, text) for each repaired row, then ("end",), for each conversation;
    ("batch",) after each slice."""
    audit, k, place, state, open_ = "", 0, 0, 0, False

    def inserted() -> Iterator[tuple]:
        nonlocal k, state
        while k < len(audit) and audit[k] == "I":
            k += 1
            initial, state = TURN[state]
            yield "row", _NAMES[initial], ""

    for b in batches(it):
        id_type = b.schema.field(0).type
        for conv, kind, facts, role, text in zip(*(c.to_pylist() for c in b.columns)):
            if kind == 0:
                if open_:
                    yield ("end",)
                audit, k, state, open_ = facts["audit"], 0, 0, True
                yield "head", conv, facts, id_type
            else:
                letter = audit[k]
                k += 1
                if letter == "K":
                    state = NEXT[role[:1]][state]
                    yield "row", role, text
                elif letter == "R":
                    initial, state = TURN[state]
                    yield "row", _NAMES[initial], text
            yield from inserted()
        yield ("batch",)
    if open_:
        yield ("end",)


_NAMES = {"u": "user", "a": "assistant"}


def _facts_batch(heads: list[tuple], more: dict[str, pa.Array], id_type: pa.DataType) -> pa.RecordBatch:
    columns = {"conv_id": pa.array([h[0] for h in heads], id_type)}
    for f in _FACTS:
        columns[f] = pa.array([h[1][f] for h in heads], pa.string() if f == "audit" else pa.int64())
    return pa.RecordBatch.from_pydict(columns | more)


def _digests(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    heads: list[tuple] = []
    digests: list[str] = []
    now = digest = id_type = None
    first = True

    def flush() -> pa.RecordBatch:
        out = _facts_batch(heads, {"repaired_sha256": pa.array(digests, pa.string())}, id_type)
        heads.clear()
        digests.clear()
        return out

    for what, *x in _edited(it):
        if what == "head":
            now, id_type, digest, first = (x[0], x[1]), x[2], hashlib.sha256(), True
        elif what == "row":
            digest.update(f"{'' if first else chr(10)}{x[0]}:{x[1]}".encode())
            first = False
        elif what == "end":
            heads.append(now)
            digests.append(digest.hexdigest())
        elif heads:
            yield flush()
    if heads:
        yield flush()


def _repaired(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    heads: list[tuple] = []
    rows: list[tuple] = []
    now = id_type = None
    place = 0

    def flush() -> pa.RecordBatch:
        out = _facts_batch(heads, {"place": pa.array([r[0] for r in rows], pa.int64()), "role": pa.array([r[1] for r in rows], pa.string()),
                                   "text": pa.array([r[2] for r in rows], pa.string())}, id_type)
        heads.clear()
        rows.clear()
        return out

    for what, *x in _edited(it):
        if what == "head":
            now, id_type, place = (x[0], x[1]), x[2], 0
        elif what == "row":
            heads.append(now)
            rows.append((place, x[0], x[1]))
            place += 1
        elif what == "end":
            if not place:
                heads.append(now)
                rows.append((None, None, None))
        elif heads:
            yield flush()
    if heads:
        yield flush()
