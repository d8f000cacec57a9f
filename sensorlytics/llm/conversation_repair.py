"""Conversation structure repair with Four-Russians block tables.

Rows of a conversation, in the order of ``turn`` (nulls first), are repaired at least cost so that the
roles' initials read ``(s?(ua)+)?``: an optional system row, then pairs of user and assistant. Keep costs
0, a new role (user or assistant) 3, deletion 4, an inserted row without text 3, and a truncated row that
stays 3 more. Blank rows and repeats of an earlier row (role and text) must go. Of the cheapest repairs the
one whose edits' initials (D, I, K, R) are least in ASCII is taken.

The costs to finish from each of the four states of the pattern form a vector; less its minimum it is one
of a few. :class:`BlockTables` holds, for every such vector and every block of ``BLOCK`` symbols, the vector
in front of the block and what is added to it. A conversation is worked through from its end, one lookup a
block; then, from its start, each block is expanded from the vector behind it and the edits are read off
forwards, so that ties go to the least edit at the first place where repairs differ.

On Spark: rows are reduced to (conversation, turn, role, digest of the text, how often) by aggregates that
combine before the shuffle; "seen earlier" is an aggregate too. A range sort spreads even one giant
conversation over all tasks, which write its symbols, one byte a row; only these strings, no larger than
the audit that comes out, meet per conversation. Texts are read once more, streamed in order past the
audit. (A digest over a whole conversation, as the query asks for, is sequential by nature: one task hashes
the conversation as a stream, holding one batch of it.)

Null role or text counts as one space; a null ``turn`` sorts first; rows of a null conversation id form one
conversation. Rows of equal turn follow role, then the SHA-256 of the text; equal rows are neighbours.
Other columns are ignored; an empty table gives an empty result; texts of any length are only streamed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlytics.llm.common import frozen, table

# Costs of the edits, and the pattern (states: start, after s, after u, after a).
NEW_ROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
START, AFTER_S, AFTER_U, AFTER_A = range(4)
ADDED = {START: AFTER_U, AFTER_S: AFTER_U, AFTER_U: AFTER_A, AFTER_A: AFTER_U}  # by an inserted or renamed row
KEPT = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A,
        (AFTER_A, "u"): AFTER_U}
ROLE_TO = {AFTER_U: "user", AFTER_A: "assistant"}
AT_END = (0, 2 * INSERT, INSERT, 0)  # what is still to be inserted
BLOCK = 4

# A row's code: its initial (other: none of the three) and its first fault.
INITIALS = "sua"
FINE, BLANK, DUPLICATE, CUT = range(4)
SPACE = r"\x20\x09-\x0D"
#: Symbols of the cost tables: one for rows that must go, then initial x truncated or not.
SYMBOLS = [None, *[(i, cut) for i in "suao" for cut in (False, True)]]
_SYMBOL_OF_CODE = np.array([0 if c % 4 in (BLANK, DUPLICATE) else 1 + 2 * (c // 4) + (c % 4 == CUT)
                            for c in range(16)], np.uint8)


def _before(symbol, after: tuple[int, ...]) -> list[int]:
    """Costs to finish in front of a row, given those behind it."""
    out = []
    for state in range(4):
        best = DELETE + after[state]
        if symbol is not None:
            initial, cut = symbol
            more = TRUNCATED if cut else 0
            best = min(best, NEW_ROLE + more + after[ADDED[state]])
            if (state, initial) in KEPT:
                best = min(best, more + after[KEPT[state, initial]])
        out.append(best)
    for _ in range(3):  # rows inserted in front of it
        out = [min(c, INSERT + out[ADDED[s]]) for s, c in enumerate(out)]
    return out


class BlockTables:
    """Transitions of normalised cost vectors over single symbols and over blocks of ``length``."""

    def __init__(self, length: int = BLOCK):
        self.length, k = length, len(SYMBOLS)
        self.vectors: list[tuple[int, ...]] = []
        ids: dict[tuple[int, ...], int] = {}

        def number(costs) -> tuple[int, int]:
            low = min(costs)
            key = tuple(c - low for c in costs)
            if key not in ids:
                ids[key] = len(self.vectors)
                self.vectors.append(key)
            return ids[key], low

        self.last, self.last_cost = number(AT_END)
        step, add = [], []
        while len(step) < len(self.vectors):  # the list grows while new vectors turn up
            found = [number(_before(s, self.vectors[len(step)])) for s in SYMBOLS]
            step.append([v for v, _ in found])
            add.append([c for _, c in found])
        self.step, self.add = np.array(step), np.array(add)
        # a block's code has its first symbol as the highest digit; its last symbol is applied first
        block, cost = np.arange(len(step))[:, None], np.zeros((len(step), 1), np.int64)
        for _ in range(length):
            cost = (cost[:, None, :] + self.add[block].transpose(0, 2, 1)).reshape(len(step), -1)
            block = self.step[block].transpose(0, 2, 1).reshape(len(step), -1)
        self.block, self.block_cost = block, cost
        self.weights = k ** np.arange(length - 1, -1, -1)
        self.walked: dict[tuple[int, int, int], tuple[str, int]] = {}

    def edit(self, after: int, symbol: int, state: int) -> tuple[str, int]:
        """Edits for one row, least first, and the state behind it."""
        behind, front = self.vectors[after], self.vectors[self.step[after, symbol]]
        add, out = int(self.add[after, symbol]), ""
        while True:
            cost = add + front[state]
            if cost == DELETE + behind[state]:
                return out + "D", state
            if front[state] == INSERT + front[ADDED[state]]:
                out, state = out + "I", ADDED[state]
                continue
            initial, cut = SYMBOLS[symbol]
            more = TRUNCATED if cut else 0
            if (state, initial) in KEPT and cost == more + behind[KEPT[state, initial]]:
                return out + "K", KEPT[state, initial]
            return out + "R", ADDED[state]

    def walk(self, after: int, code: int, state: int) -> tuple[str, int]:
        """Expand a block from the vector behind it, then read its edits off forwards."""
        found = self.walked.get((after, code, state))
        if found is None:
            symbols = [code // int(w) % len(SYMBOLS) for w in self.weights]
            behind = [after]
            for s in symbols[:0:-1]:
                behind.append(int(self.step[behind[-1], s]))
            at, edits = state, []
            for v, s in zip(reversed(behind), symbols):
                done, at = self.edit(v, s, at)
                edits.append(done)
            found = self.walked[after, code, state] = "".join(edits), at
        return found

    def repair(self, symbols: np.ndarray) -> tuple[int, str]:
        """Least cost and its least audit."""
        n, size = len(symbols), self.length
        full = n // size * size
        rest = symbols[full:].tolist()
        tail = [self.last]
        total = self.last_cost
        for s in reversed(rest):
            total += int(self.add[tail[-1], s])
            tail.append(int(self.step[tail[-1], s]))
        codes = (symbols[:full].reshape(-1, size).astype(np.int64) @ self.weights).tolist()
        vector, behind = tail[-1], np.empty(len(codes), np.int32)
        for i in range(len(codes) - 1, -1, -1):
            behind[i] = vector
            total += int(self.block_cost[vector, codes[i]])
            vector = int(self.block[vector, codes[i]])
        total += self.vectors[vector][START]
        state, audit = START, []
        for code, v in zip(codes, behind.tolist()):
            edits, state = self.walk(v, code, state)
            audit.append(edits)
        for v, s in zip(reversed(tail[:-1]), rest):
            edits, state = self.edit(v, s, state)
            audit.append(edits)
        audit.append("I" * (AT_END[state] // INSERT))
        return total, "".join(audit)


@lru_cache(maxsize=1)
def block_tables() -> BlockTables:
    return BlockTables()


def illegal_pairs(codes: np.ndarray) -> int:
    """Adjacent initials other than su, ua, au."""
    i = codes // 4
    a, b = i[:-1], i[1:]
    s, u, v = 0, 1, 2
    return int(len(a) - np.count_nonzero(((a == s) & (b == u)) | ((a == u) & (b == v)) | ((a == v) & (b == u))))


# ------------------------------------------------------------------ on Spark

def _plain(rows: DataFrame) -> DataFrame:
    """conv_id (long, or text), turn, role, text, copies; nulls of role and text as one space."""
    copies = F.col("copies").cast("long") if "copies" in rows.columns else F.lit(1).cast("long")
    whole = isinstance(rows.schema["conv_id"].dataType, T.IntegralType)
    conv_id = F.col("conv_id").cast("long" if whole else "string").alias("conv_id")
    return rows.select(conv_id, F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                       F.coalesce("text", F.lit(" ")).alias("text"), copies.alias("copies"))


def _arrow(field: T.StructField) -> pa.DataType:
    return pa.int64() if isinstance(field.dataType, T.LongType) else pa.string()


def _digest() -> Column:
    return F.unhex(F.sha2(F.col("text"), 256))


def _coded_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, n, code): distinct rows with their number; ``code`` (initial and fault)
    where this is the first place of its role and text, null where it only repeats an earlier one."""
    marked = rows.select("conv_id", "turn", "role", _digest().alias("digest"), "copies",
                         F.when(~F.col("text").rlike(f"[^{SPACE}]"), BLANK)
                         .when(~F.col("text").rlike(rf"[.!?][{SPACE}]*\z"), CUT).otherwise(FINE).alias("fault"))
    firsts = (marked.where("copies > 0").groupBy("conv_id", "role", "digest")
              .agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))).alias("at"),
                   F.max("fault").alias("fault")))
    initial = F.coalesce(F.nullif(F.instr(F.lit(INITIALS), F.substring("role", 1, 1)), F.lit(0)), F.lit(4)) - 1
    initial = F.when(F.length("role") == 0, 3).otherwise(initial)
    firsts = firsts.select("conv_id", F.col("at.turn").alias("turn"), "role", "digest", F.lit(0).cast("long").alias("copies"),
                           (initial * 4 + F.col("fault")).cast("int").alias("code"))
    everywhere = marked.select("conv_id", "turn", "role", "digest", "copies",
                               F.when(F.col("fault") == BLANK, initial * 4 + BLANK)
                               .otherwise(initial * 4 + DUPLICATE).cast("int").alias("again"))
    return (everywhere.withColumn("code", F.lit(None).cast("int"))
            .unionByName(firsts.withColumn("again", F.lit(None).cast("int")))
            .groupBy("conv_id", "turn", "role", "digest")
            .agg(F.sum("copies").alias("n"), F.max("code").alias("code"), F.max("again").alias("again")))


def _segments(batches: Iterable[pa.RecordBatch], kind: pa.DataType, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Code strings of the sorted rows: one row per conversation and ``most`` rows of it at most, with the
    first and last turn and the number of turns seen."""
    at, seq = TaskContext.get().partitionId(), 0
    names = ["conv_id", "at", "seq", "codes", "first_turn", "last_turn", "turns"]
    conv, codes, first, last, turns, open_ = None, bytearray(), None, None, 0, False
    done: list[tuple] = []

    def out():
        cols = list(zip(*done))
        kinds = [kind, pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    for batch in batches:
        for c, turn, n, code, again in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if open_ and (c != conv or len(codes) >= most):
                done.append((conv, at, seq, bytes(codes), first, last, turns))
                seq += 1
                codes, first, last, turns = bytearray(), None, None, 0
                if len(done) >= 4096:
                    yield out()
            conv, open_ = c, True
            if not n:
                continue
            for k in range(0, n, most):  # many equal rows are written in pieces
                part = bytes([again]) * min(most, n - k)
                codes += part if k or code is None else bytes([code]) + part[1:]
            if turn is not None and (last is None or turn != last):
                first, last, turns = turn if first is None else first, turn, turns + 1
    if open_:
        done.append((conv, at, seq, bytes(codes), first, last, turns))
    if done:
        yield out()


def _audit_rows(batches: Iterable[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    tables = block_tables()
    names = ["conv_id", *_COUNTS, "audit"]
    for batch in batches:
        rows = []
        for conv, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            codes = np.frombuffer(b"".join(p["codes"] for p in parts), np.uint8)
            low = high = None
            turns = 0
            for p in parts:
                if p["first_turn"] is None:
                    continue
                turns += p["turns"] - (high == p["first_turn"])
                low, high = p["first_turn"] if low is None else low, p["last_turn"]
            gaps = 0 if low is None else high - low + 1 - turns
            count = np.bincount(codes % 4, minlength=4).tolist()
            cost, audit = tables.repair(_SYMBOL_OF_CODE[codes])
            rows.append((conv, gaps, count[BLANK], count[DUPLICATE], count[CUT], illegal_pairs(codes), cost, audit))
        cols = list(zip(*rows)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(
            cols, [kind, *[pa.int64()] * 6, pa.string()])], names=names)


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def audits(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, optionally copies: how often the row
    stands there, 0 included): gaps, blank, duplicate, truncated, illegal, cost and audit."""
    spark = rows.sparkSession
    coded = frozen(_coded_rows(_plain(rows)), "repair-rows")
    kind = coded.schema["conv_id"]
    arrow = _arrow(kind)
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    p = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = (coded.repartitionByRange(p, *order).sortWithinPartitions(*order)
                   .select("conv_id", "turn", "n", "code", "again"))
    schema = T.StructType([kind])
    for name, t in (("at", "integer"), ("seq", "integer"), ("codes", "binary"), ("first_turn", "long"), ("last_turn", "long"),
                    ("turns", "long")):
        schema = schema.add(name, t)
    pieces = frozen(sorted_rows.mapInArrow(lambda b: _segments(b, arrow), schema), "repair-segments")
    per_conv = pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("at", "seq", "codes", "first_turn", "last_turn", "turns"))).alias("parts"))
    out = T.StructType([kind])
    for name in _COUNTS:
        out = out.add(name, "long")
    out = out.add("audit", "string")
    return per_conv.mapInArrow(lambda b: _audit_rows(b, arrow), out)


class Editor:
    """Applies an audit to the rows of a conversation as they come by."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _inserted(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at:self.at + 1] == "I":
            self.at, self.state = self.at + 1, ADDED[self.state]
            yield ROLE_TO[self.state], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        """The rows that come out with this one: those inserted before it, and itself unless deleted."""
        yield from self._inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            self.state = KEPT[self.state, role[:1]]
            yield role, text
        elif edit == "R":
            self.state = ADDED[self.state]
            yield ROLE_TO[self.state], text

    def end(self) -> Iterator[tuple[str, str]]:
        yield from self._inserted()


def _in_order(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Per conversation its audit, then its rows: (conv_id, audit, role, text, copies), sorted in the task."""
    plain = _plain(rows).where("copies > 0").withColumn("digest", _digest())
    head = found.select("conv_id", "audit")
    both = plain.withColumn("audit", F.lit(None).cast("string")).unionByName(head, allowMissingColumns=True)
    keys = [F.col("conv_id"), F.col("audit").isNull(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    return both.repartition("conv_id").sortWithinPartitions(*keys).select("conv_id", "audit", "role", "text", "copies")


def _edited(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, role, text) of repaired rows; each conversation begins with (conv_id, None, audit)."""
    conv, editor = None, None
    for batch in batches:
        for c, audit, role, text, copies in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if audit is not None:
                if editor:
                    yield from ((conv, r, t) for r, t in editor.end())
                conv, editor = c, Editor(audit)
                yield c, None, audit
                continue
            for _ in range(copies):
                yield from ((conv, r, t) for r, t in editor.row(role, text))
    if editor:
        yield from ((conv, r, t) for r, t in editor.end())


def repaired_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired conversations: (conv_id, position, role, text), ``found`` being ``audits(rows)``."""
    kind = found.schema["conv_id"]
    arrow = _arrow(kind)

    def run(batches):
        out, size, at = [], 0, 0
        names, kinds = ["conv_id", "position", "role", "text"], [arrow, pa.int64(), pa.string(), pa.string()]

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

        for conv, role, text in _edited(batches):
            if role is None:
                at = 0
                continue
            out.append((conv, at, role, text))
            at, size = at + 1, size + len(text)
            if size > 4 << 20 or len(out) >= 10_000:
                yield flush()
                out, size = [], 0
        if out:
            yield flush()

    return _in_order(rows, found).mapInArrow(run, T.StructType([kind]).add("position", "long")
                                             .add("role", "string").add("text", "string"))


def repaired_digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): SHA-256 over ``role:text`` of the repaired rows, joined by newlines."""
    kind = found.schema["conv_id"]
    arrow = _arrow(kind)

    def run(batches):
        done: list[tuple] = []
        conv, digest, first = None, None, True

        def flush():
            batch = pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], arrow), pa.array([h for _, h in done], pa.string())],
                                               names=["conv_id", "repaired_sha256"])
            done.clear()
            return batch

        for c, role, text in _edited(batches):
            if role is None:
                if digest:
                    done.append((conv, digest.hexdigest()))
                    if len(done) >= 10_000:
                        yield flush()
                conv, digest, first = c, hashlib.sha256(), True
                continue
            digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
            first = False
        if digest:
            done.append((conv, digest.hexdigest()))
        if done:
            yield flush()

    return _in_order(rows, found).mapInArrow(run, T.StructType([kind]).add("repaired_sha256", "string"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of ``conversations`` as the query damages them, by crc32 of ``conv_id:turn`` modulo 20 (nulls are
    one space): 0 none is left (``copies`` 0), 1 without text, 2 without ``.!?``, 3 twice, 4 from the user."""
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    how = F.crc32(name.cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    return conversations.select(
        "conv_id", "turn", F.when(how == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(how == 1, "").when(how == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(how == 0, 0).when(how == 3, 2).otherwise(1).alias("copies"))


def op12_conversation_repair(spark, sf_dir: str) -> DataFrame:
    rows = damaged(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    found = frozen(audits(rows), "repair-audits")
    same = F.col("conv_id").eqNullSafe(F.col("_conv"))
    digests = repaired_digests(rows, found).withColumnRenamed("conv_id", "_conv")
    return found.join(digests, same).drop("_conv")


def _oracle() -> str:
    """DuckDB SQL of the query: a forward search over rows. The best way into each state is kept as one
    string, nine digits of cost and the audit, so that the least string is the answer, ties included."""

    def then(key: str, edit: str, cost: str | int) -> str:
        return f"printf('%09d', substr({key}, 1, 9)::INT + {cost}) || substr({key}, 10) || '{edit}'"

    def row(ways: list[str]) -> str:
        return f"least({', '.join(ways)})"

    never = "'900000000'"
    put = {e: (lambda k, e=e, c=c: then(k, e, c)) for e, c in (("D", DELETE), ("I", INSERT), ("K", "more"), ("R", f"{NEW_ROLE} + more"))}

    def keep(key: str, initial: str) -> str:
        return f"CASE WHEN NOT must_go AND initial = '{initial}' THEN {put['K'](key)} ELSE {never} END"

    def rename(key: str) -> str:
        return f"CASE WHEN NOT must_go THEN {put['R'](key)} ELSE {never} END"

    crc = ("list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(name, ''), lambda x: ord(x)::BIGINT)), "
           "lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), "
           "lambda d, i: xor(d >> 1, (d & 1) * 3988292384::BIGINT)))")
    to_u = ["s0", "s1", "a"]
    return f"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
dealt AS (SELECT *, xor({crc}, 4294967295::BIGINT) % 20 AS how FROM named),
damaged AS (
  SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
    CASE how WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE how WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM dealt),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos FROM damaged),
repeats AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again FROM numbered),
judged AS (
  SELECT conv_id, turn, role, text, pos, substr(role, 1, 1) AS initial,
    CASE WHEN NOT regexp_matches(text, '[^{SPACE}]') THEN 'blank' WHEN again THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][{SPACE}]*\\z') THEN 'truncated' ELSE '' END AS fault FROM repeats),
marked AS (SELECT *, fault IN ('blank', 'duplicate') AS must_go, CASE fault WHEN 'truncated' THEN {TRUNCATED} ELSE 0 END AS more FROM judged),
walk AS (
  SELECT conv_id, 0::BIGINT AS pos, '000000000' AS s0, {never} AS s1, {never} AS s2, {never} AS s3
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, pos, {put['D']('s0')}, {row([put['D']('s1'), keep('s0', 's')])},
    {row([put['D']('u'), *[keep(k, 'u') for k in to_u], *[rename(k) for k in to_u]])},
    {row([put['D']('a'), keep('u', 'a'), rename('u')])}
  FROM (SELECT *, least(s3, {put['I']('u')}) AS a FROM (
    SELECT m.conv_id, m.pos, must_go, more, initial, s0, s1, s3, {row(['s2', *[put['I'](k) for k in ('s0', 's1', 's3')]])} AS u
    FROM walk JOIN marked m ON m.conv_id IS NOT DISTINCT FROM walk.conv_id AND m.pos = walk.pos + 1))),
ends AS (
  SELECT conv_id, least(s0, s3, {put['I'](row(['s2', *[put['I'](k) for k in ('s0', 's1', 's3')]]))}) AS best
  FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY pos DESC) = 1),
audits AS (SELECT conv_id, substr(best, 1, 9)::BIGINT AS cost, substr(best, 10) AS audit FROM ends),
edits AS (
  SELECT conv_id, place, edit, sum((edit <> 'I')::INT) OVER (PARTITION BY conv_id ORDER BY place) AS pos FROM (
    SELECT conv_id, unnest(range(1, length(audit) + 1)) AS place, unnest(string_split(audit, '')) AS edit FROM audits WHERE audit <> '')),
kept AS (
  SELECT e.conv_id, place, edit, m.role, m.text, row_number() OVER w AS nr,
    first_value(edit = 'K' AND m.initial = 's') OVER w AS system FROM edits e
  LEFT JOIN marked m ON m.conv_id IS NOT DISTINCT FROM e.conv_id AND m.pos = e.pos
  WHERE edit <> 'D' WINDOW w AS (PARTITION BY e.conv_id ORDER BY place)),
texts AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (nr - system::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY place)) AS digest FROM kept GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'blank') AS blank,
    count_if(fault = 'duplicate') AS duplicate, count_if(fault = 'truncated') AS truncated,
    count_if(before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) AS before FROM marked) GROUP BY conv_id)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, cost, audit,
  coalesce(digest, sha256('')) AS repaired_sha256
FROM audits a LEFT JOIN counts c ON a.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN texts t ON a.conv_id IS NOT DISTINCT FROM t.conv_id
"""


ORACLE = _oracle()
