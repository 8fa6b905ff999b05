"""Conversation structure repair by a suffix-shared automaton of role and fault signatures.

A conversation becomes a signature: a character per row for its role's initial and its fault. What
the rest of a conversation costs to repair depends on the rest of its signature and on the grammar
state alone, so signatures share their ends: a node stands for one suffix and leads to the next
shorter one. Signatures are range-partitioned in the order of their reversed text, which puts those
with a common end beside each other (a hot signature is divided by conversation); a task holds the
nodes of the current signature as a stack, keeps those of the common end and adds the others. So a
node is worked out once per task, and a task holds no more than its longest signature. A node has,
for each grammar state, the cost to go and the first edit of the best audit suffix, which links to
the suffix that follows it. Nodes that differ in all costs by the same amount have the same edits and
so share one table.

The grammar of role initials is ``(s?(ua)+)?``. Edits: Keep 0, Rerole to user or assistant 1, Delete
2 (required for blank rows and duplicates), Insert an empty user or assistant row 5; a truncated row
that stays adds 5. Of the cheapest audits the least in ASCII order is taken. From a state each edit
leads to one state only, so taking the least first edit at each node gives it.

Faults, of which a row has the first that holds: blank (only spaces and 0x09-0x0D), duplicate (role
and text as in an earlier row of the conversation), truncated (the last other character is none of
``.!?``). Duplicates are found by a window over conversation, role and text, so a long conversation
is divided there. Texts travel once, in the last step; before it their SHA-256 stands for them.

Nulls: a null role or text reads as one space; null turns come first; rows without a conversation id
are one conversation. Rows of one turn go by role and then by the SHA-256 of the text; repeated rows
stay and are duplicates. Other columns are not read. An empty table gives no rows. One task streams
the rows of a conversation in order, whatever its length, and holds its signature or audit (a
character a row) only.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.llm.common import table
from zonalis.session import stage

KEEP_TRUNCATED, REROLE, DELETE, INSERT = 5, 1, 2, 5
INFINITE = 1 << 60
#: Grammar states: nothing yet, after s, after u, after a.
START, OPENED, ASKED, ANSWERED = range(4)
STATES = (START, OPENED, ASKED, ANSWERED)
#: The state after a user or assistant row where one is due.
DUE = (ASKED, ASKED, ANSWERED, ASKED)
KEPT = ({"s": OPENED, "u": ASKED}, {"u": ASKED}, {"a": ANSWERED}, {"u": ASKED})
#: Signature characters: role initial (x: another), in upper case if truncated; d: must go.
GONE = "d"
OWN = r"[^\x20\x09-\x0D]"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"

Table = tuple[tuple[int, ...], str]


def with_inserts(costs: list[int], edits: list[str]) -> Table:
    """The same with Insert allowed before: the row due in a state costs as much from any of them."""
    asked, answered = costs[ASKED], costs[ANSWERED]
    for state, onward in ((ASKED, answered), (ANSWERED, asked)):
        if (onward + INSERT, "I") < (costs[state], edits[state]):
            costs[state], edits[state] = onward + INSERT, "I"
    for state in (START, OPENED):
        if (costs[ASKED] + INSERT, "I") < (costs[state], edits[state]):
            costs[state], edits[state] = costs[ASKED] + INSERT, "I"
    return tuple(costs), "".join(edits)


#: After the last row: an audit may stop after nothing or after an answer.
END = with_inserts([0, INFINITE, INFINITE, 0], ["."] * 4)


def edited(symbol: str, onward: tuple[int, ...]) -> Table:
    """Cost to go and first edit by state before a row, given the costs behind it."""
    initial = symbol.lower()
    stays = KEEP_TRUNCATED if symbol.isupper() else 0
    costs, edits = [], []
    for state in STATES:
        found = [(DELETE + onward[state], "D")]
        if symbol != GONE:
            found.append((REROLE + stays + onward[DUE[state]], "R"))
            if initial in KEPT[state]:
                found.append((stays + onward[KEPT[state][initial]], "K"))
        cost, edit = min(found)
        costs.append(cost)
        edits.append(edit)
    return with_inserts(costs, edits)


class Automaton:
    """The nodes of the suffixes of one signature; those of its common end with the next one stay."""

    def __init__(self):
        self.symbols = ""  # reversed signature
        self.costs: list[tuple[int, ...]] = [END[0]]  # less their base
        self.base = [0]
        self.edits = [END[1]]
        self.tables: dict[tuple, Table] = {}
        self.made = 0

    def load(self, signature: str) -> None:
        symbols = signature[::-1]
        same = 0
        for a, b in zip(symbols, self.symbols, strict=False):
            if a != b:
                break
            same += 1
        del self.costs[same + 1 :], self.base[same + 1 :], self.edits[same + 1 :]
        for symbol in symbols[same:]:
            key = symbol, self.costs[-1]
            known = self.tables.get(key)
            if known is None:
                known = self.tables[key] = edited(symbol, self.costs[-1])
            least = min(known[0])
            self.costs.append(tuple(min(c - least, INFINITE) for c in known[0]))
            self.base.append(self.base[-1] + least)
            self.edits.append(known[1])
        self.made += len(symbols) - same
        self.symbols = symbols

    def best(self) -> tuple[int, str]:
        """Cost and audit of the signature that was loaded."""
        at, state, audit = len(self.symbols), START, []
        cost = self.base[at] + self.costs[at][START]
        while (edit := self.edits[at][state]) != ".":
            audit.append(edit)
            if edit == "I":
                state = DUE[state]
                continue
            at -= 1
            if edit == "R":
                state = DUE[state]
            elif edit == "K":
                state = KEPT[state][self.symbols[at].lower()]
        return cost, "".join(audit)


ROW = ["turn", "role", "digest"]
SIGNED = "turns bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, signature string"


def _rows(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    said = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(" "))
    return turns.select(F.col(f"`{conv}`").alias("id"), F.col(f"`{turn}`").cast("bigint").alias("turn"),
                        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(" ")).alias("role"), said.alias("text"),
                        F.unhex(F.sha2(said, 256)).alias("digest"))


def signatures(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
               text: str = "text") -> DataFrame:
    """One row per conversation: id, number of rows, missing turns, rows by fault, illegal neighbours
    (role initials that are not su, ua or au), signature."""
    nth = F.expr("row_number() OVER (PARTITION BY id, role, digest ORDER BY turn NULLS FIRST)")
    rows = _rows(turns, conv, turn, role, text)
    light = rows.select("id", *ROW, F.when(~F.col("text").rlike(OWN), "blank")
                        .when(~F.col("text").rlike(ENDED), "truncated").otherwise("none").alias("own"))
    fault = F.when((F.col("own") != "blank") & (F.col("nth") > 1), "duplicate").otherwise(F.col("own"))
    light = light.withColumn("nth", nth).withColumn("fault", fault)
    light = light.select("id", *ROW, F.substring("role", 1, 1).alias("initial"), "fault")
    ordered = light.repartition("id").sortWithinPartitions("id", F.asc_nulls_first("turn"), "role", "digest")
    kind = ordered.schema["id"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Signature()
        for batch in batches:
            done = []
            columns = (batch.column(c).to_pylist() for c in ("id", "turn", "initial", "fault"))
            for name, number, initial, fault in zip(*columns, strict=True):
                if held.symbols and name != held.name:
                    done.append(held.row())
                    held = _Signature()
                held.add(name, number, initial, fault)
            yield _signed(done, batch.schema.field("id").type)
        if held.symbols:
            yield _signed([held.row()], batch.schema.field("id").type)

    signed = ordered.select("id", "turn", "initial", "fault").mapInArrow(sign, f"id {kind}, {SIGNED}")
    return signed.withColumnRenamed("id", conv)


class _Signature:
    """The running signature and counts of one conversation, rows given in order."""

    def __init__(self):
        self.name = None
        self.symbols: list[str] = []
        self.first = self.last = self.before = None
        self.distinct = self.illegal = 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0, "none": 0}

    def add(self, name, turn: int | None, initial: str, fault: str) -> None:
        self.name = name
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.distinct += 1
        if self.symbols:
            self.illegal += self.before + initial not in ("su", "ua", "au")
        self.before = initial
        self.faults[fault] += 1
        symbol = initial if initial in ("s", "u", "a") else "x"
        if fault in ("blank", "duplicate"):
            symbol = GONE
        self.symbols.append(symbol.upper() if fault == "truncated" else symbol)

    def row(self) -> tuple:
        gaps = self.last - self.first + 1 - self.distinct if self.distinct else 0
        faults = (self.faults[f] for f in ("blank", "duplicate", "truncated"))
        return (self.name, len(self.symbols), gaps, *faults, self.illegal, "".join(self.symbols))


def _signed(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 8
    types = [kind, *[pa.int64()] * 6, pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                      ["id", "turns", "gaps", "blank", "duplicate", "truncated", "illegal", "signature"])


def plan_repairs(signed: DataFrame, conv: str = "conv_id") -> DataFrame:
    """``signatures`` with ``cost`` and ``audit`` in place of the signature."""
    spark = signed.sparkSession
    near = F.reverse("signature")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    routed = signed.repartitionByRange(parts, near, F.col(f"`{conv}`")).sortWithinPartitions(near, F.col(f"`{conv}`"))
    kept = [c for c in signed.columns if c != "signature"]
    shape = ", ".join(f"`{c}` {signed.schema[c].dataType.simpleString()}" for c in kept) + ", cost bigint, audit string"

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, last, best = Automaton(), None, (0, "")
        for batch in batches:
            found = []
            for signature in batch.column("signature").to_pylist():
                if signature != last:
                    automaton.load(signature)
                    last, best = signature, automaton.best()
                found.append(best)
            costs, audits = zip(*found, strict=True) if found else ((), ())
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(costs, pa.int64()), pa.array(audits, pa.string())],
                                             [*kept, "cost", "audit"])

    return routed.mapInArrow(walk, shape)


EDITS = "place bigint, edit string, role string, text string"


def apply_repairs(turns: DataFrame, plans: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """One row per edit: id, ``place`` in the audit, ``edit``, and the role and text that result.

    A deleted row has neither. Rows of a conversation lie in one partition in the order of the audit.
    """
    rows = _rows(turns, conv, turn, role, text).withColumn("audit", F.lit(None).cast("string"))
    plans = plans.select(F.col(f"`{conv}`").alias("id"), "audit")
    both = rows.unionByName(plans, allowMissingColumns=True).repartition("id")
    ordered = both.sortWithinPartitions("id", F.col("audit").isNull(), F.asc_nulls_first("turn"), "role", "digest")
    kind = rows.schema["id"].dataType.simpleString()

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, state, name, id_type = "", 0, START, None, None

        def inserts() -> Iterator[tuple]:
            nonlocal at, state
            while at < len(audit) and audit[at] == "I":
                yield name, at, "I", "assistant" if state == ASKED else "user", ""
                state, at = DUE[state], at + 1

        for batch in batches:
            id_type = batch.schema.field("id").type
            done: list[tuple] = []
            columns = (batch.column(c).to_pylist() for c in ("id", "audit", "role", "text"))
            for key, found, said_by, said in zip(*columns, strict=True):
                if found is not None:  # the plan of the next conversation
                    done.extend(inserts())
                    audit, at, state, name = found, 0, START, key
                    continue
                done.extend(inserts())
                made = audit[at]
                if made == "D":
                    done.append((key, at, "D", None, None))
                elif made == "R":
                    done.append((key, at, "R", "assistant" if state == ASKED else "user", said))
                    state = DUE[state]
                else:
                    done.append((key, at, "K", said_by, said))
                    state = KEPT[state][said_by[0]]
                at += 1
            yield _edits(done, id_type)
        if id_type is not None:
            yield _edits(list(inserts()), id_type)

    edits = ordered.select("id", "audit", "role", "text").mapInArrow(edit, f"id {kind}, {EDITS}")
    return edits.withColumnRenamed("id", conv)


def _edits(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 5
    types = [kind, pa.int64(), pa.string(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                      ["id", "place", "edit", "role", "text"])


def digests(edits: DataFrame, conv: str = "conv_id") -> DataFrame:
    """SHA-256 of each repaired conversation as ``role:text`` lines; ``edits`` as ``apply_repairs`` gives
    them. A conversation whose rows were all deleted has the hash of nothing."""
    kind = edits.schema[conv].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running, name, begun, id_type, some = hashlib.sha256(), None, False, None, False
        for batch in batches:
            id_type = batch.schema.field("id").type
            done = []
            columns = (batch.column(c).to_pylist() for c in ("id", "place", "role", "text"))
            for key, place, role, text in zip(*columns, strict=True):
                if place == 0:
                    if some:
                        done.append((name, running.hexdigest()))
                    running, name, begun, some = hashlib.sha256(), key, False, True
                if role is not None:
                    running.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
                    begun = True
            yield _hashed(done, id_type)
        if some:
            yield _hashed([(name, running.hexdigest())], id_type)

    named = edits.withColumnRenamed(conv, "id").select("id", "place", "role", "text")
    return named.mapInArrow(digest, f"id {kind}, repaired_sha256 string").withColumnRenamed("id", conv)


def _hashed(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    names, hashes = zip(*rows, strict=True) if rows else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(names, kind), pa.array(hashes, pa.string())], ["id", "repaired_sha256"])


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with planted faults by the remainder of crc32(``conv_id:turn``) by 20; nulls are one space."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    code = F.crc32(F.concat(said[0], F.lit(":"), said[1]).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", said[2].alias("role"), said[3].alias("text"), code.alias("code"))
    rows = rows.where("code != 0")
    rows = rows.withColumn("text", F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", ""))
                           .otherwise(F.col("text")))
    rows = rows.withColumn("role", F.when(F.col("code") == 4, "user").otherwise(F.col("role")))
    copies = F.expr("explode(sequence(1, if(code = 3, 2, 1)))")
    return rows.select("conv_id", "turn", "role", "text", copies.alias("copy")).drop("copy")


def op12_repair(spark, sf_dir):
    """Faults, cheapest edits and repaired text of every damaged conversation, as digests."""
    original = table(spark, sf_dir, "conversations")
    rows = damaged(original)
    plans = stage(plan_repairs(stage(signatures(rows), "signatures")), "repairs")
    hashes = digests(apply_repairs(rows, plans))
    every = original.select(F.col("conv_id").alias("id")).distinct()
    found = every.join(plans, F.col("id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    found = found.join(hashes, F.col("id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in
              ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(F.col("id").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


OP12_SQL = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(4294967295::BIGINT, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(
        string_split(coalesce(cast(conv_id AS varchar), ' ') || ':' || coalesce(cast(turn AS varchar), ' '), ''),
        lambda x: ord(x)::BIGINT)),
      lambda c, b: list_reduce([xor(c, b), 1::BIGINT, 2, 3, 4, 5, 6, 7, 8],
        lambda d, k: CASE WHEN d % 2 = 1 THEN xor(d // 2, 3988292384::BIGINT) ELSE d // 2 END))) % 20 AS code
  FROM conversations),
said AS (
  SELECT conv_id, turn, CASE code WHEN 4 THEN 'user' ELSE role END AS role,
    CASE code WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN code = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM keyed WHERE code != 0),
placed AS (
  SELECT *, left(role, 1) AS initial,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
    count(*) OVER (PARTITION BY conv_id) AS n
  FROM said),
faults AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS neighbours
  FROM placed),
-- cost and audit of rows i.. by state: nothing yet, after s, after u, after a
ahead AS (
  SELECT DISTINCT conv_id, n + 1 AS i, {'c': 0, 'a': ''} AS s0, {'c': 10, 'a': 'II'} AS s1, {'c': 5, 'a': 'I'} AS s2,
    {'c': 0, 'a': ''} AS s3 FROM faults
  UNION ALL
  SELECT conv_id, i,
    list_min([b0, {'c': m2.c + 5, 'a': 'I' || m2.a}]), list_min([b1, {'c': m2.c + 5, 'a': 'I' || m2.a}]), m2, m3
  FROM (
    SELECT *, list_min([b2, {'c': b3.c + 5, 'a': 'I' || b3.a}]) AS m2, list_min([b3, {'c': b2.c + 5, 'a': 'I' || b2.a}]) AS m3
    FROM (
      SELECT f.conv_id, f.i,
        CASE WHEN fault IN ('blank', 'duplicate') THEN {'c': s0.c + 2, 'a': 'D' || s0.a} ELSE list_min([
          {'c': s0.c + 2, 'a': 'D' || s0.a}, {'c': s2.c + t + 1, 'a': 'R' || s2.a},
          {'c': s2.c + t + CASE initial WHEN 'u' THEN 0 ELSE 1000000 END, 'a': 'K' || s2.a},
          {'c': s1.c + t + CASE initial WHEN 's' THEN 0 ELSE 1000000 END, 'a': 'K' || s1.a}]) END AS b0,
        CASE WHEN fault IN ('blank', 'duplicate') THEN {'c': s1.c + 2, 'a': 'D' || s1.a} ELSE list_min([
          {'c': s1.c + 2, 'a': 'D' || s1.a}, {'c': s2.c + t + 1, 'a': 'R' || s2.a},
          {'c': s2.c + t + CASE initial WHEN 'u' THEN 0 ELSE 1000000 END, 'a': 'K' || s2.a}]) END AS b1,
        CASE WHEN fault IN ('blank', 'duplicate') THEN {'c': s2.c + 2, 'a': 'D' || s2.a} ELSE list_min([
          {'c': s2.c + 2, 'a': 'D' || s2.a}, {'c': s3.c + t + 1, 'a': 'R' || s3.a},
          {'c': s3.c + t + CASE initial WHEN 'a' THEN 0 ELSE 1000000 END, 'a': 'K' || s3.a}]) END AS b2,
        CASE WHEN fault IN ('blank', 'duplicate') THEN {'c': s3.c + 2, 'a': 'D' || s3.a} ELSE list_min([
          {'c': s3.c + 2, 'a': 'D' || s3.a}, {'c': s2.c + t + 1, 'a': 'R' || s2.a},
          {'c': s2.c + t + CASE initial WHEN 'u' THEN 0 ELSE 1000000 END, 'a': 'K' || s2.a}]) END AS b3
      FROM (SELECT *, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS t FROM faults) f
      JOIN ahead ON ahead.conv_id IS NOT DISTINCT FROM f.conv_id AND ahead.i = f.i + 1))),
best AS (SELECT conv_id, s0.c AS cost, s0.a AS audit FROM ahead WHERE i = 1),
edits AS (
  SELECT conv_id, k, substr(audit, k, 1) AS edit
  FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS k FROM best)),
numbered AS (
  SELECT *, sum(CASE edit WHEN 'I' THEN 0 ELSE 1 END) OVER w AS i, sum(CASE edit WHEN 'D' THEN 0 ELSE 1 END) OVER w AS o
  FROM edits WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
joined AS (
  SELECT e.conv_id, e.k, e.edit, e.o, f.role, f.text, f.initial,
    max(CASE WHEN e.o = 1 AND e.edit = 'K' AND f.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS opened
  FROM numbered e LEFT JOIN faults f
    ON e.conv_id IS NOT DISTINCT FROM f.conv_id AND e.i = f.i AND e.edit != 'I'
  WHERE e.edit != 'D'),
texts AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (o - opened) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || coalesce(text, ''), chr(10) ORDER BY k) AS whole
  FROM joined GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (neighbours NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON o.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN texts t ON o.conv_id IS NOT DISTINCT FROM t.conv_id"""
