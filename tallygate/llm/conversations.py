"""Conversation structure repair: cheapest edits, found once for each shared ending.

Every conversation becomes a signature: a letter for each row, which says by whom it is and
what is wrong with it. Signatures are read from the end into an automaton of shared suffixes
(a DAWG): one node stands for an ending, however many conversations have it. A node knows,
for each state of the grammar, the cheapest cost of what is left and the edit that comes first
on that way, so its best audit suffix is its own edit and that of the node behind it. Distinct
signatures are dealt out in the order of their endings; a task walks them as the branches of a
tree, holding only the nodes of one signature, and makes every node once (endings that lie on
the border of two tasks once in each).

Edits that cost the same differ in their first initial, as each edit leads to one next state;
so the least initial gives the least audit.

The digest of a repaired conversation is one hash over its rows in order. Its rows pass through
one task for that, sorted by Spark and never held together: what a task keeps of a conversation
is a letter for each row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygate.llm.common import BROADCAST_ROWS, cut

# --- Fixed values: costs, white space, legal neighbours, the SHA-256 of nothing -------------
RELABEL, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
SPACES = " \t\n\x0b\x0c\r"
LEGAL = ("su", "ua", "au")
ENDS = (".", "!", "?")
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

# States of the grammar (s?(ua)+)?: nothing yet, after s, after u, after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STATES = range(4)
KEPT = {
    (START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U,
    (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U,
}
#: Where a row that is made a user's or an assistant's leads, be it relabelled or inserted.
MADE = {START: AFTER_U, AFTER_S: AFTER_U, AFTER_U: AFTER_A, AFTER_A: AFTER_U}
MADE_ROLE = {START: "user", AFTER_S: "user", AFTER_U: "assistant", AFTER_A: "user"}

ROLES = "sua"  # others are o
CLEAN, BLANK, DUPLICATE, CUT_SHORT = range(4)
MUST_GO = "-"
#: Letter of a signature, by 4 * role + fault.
LETTERS = np.frombuffer(
    "".join(r + MUST_GO * 2 + r.upper() for r in ROLES + "o").encode(), np.uint8
)
LEGAL_PAIR = np.array([[a + b in LEGAL for b in ROLES + "o"] for a in ROLES + "o"])

#: Letters of signatures and audits that are sent to every executor.
BROADCAST_LETTERS = 16_000_000
#: Shares of a signature's conversations, where there are more signatures than that.
SALTS = 32
SUMMARY = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


# --- Automaton ------------------------------------------------------------------------------

#: For each state: cost of all that is left, and the initial of the edit that comes first.
Node = tuple[tuple[int, str], ...]


def _with_insertions(bare: list[tuple[int, str]]) -> Node:
    """Nodes where a row may also be put in first. Two in a row, back to the same state, never
    pay, so looking at each state's own way is enough for the two that lead to each other."""
    after_u = min(bare[AFTER_U], (INSERT + bare[AFTER_A][0], "I"))
    after_a = min(bare[AFTER_A], (INSERT + bare[AFTER_U][0], "I"))
    first = (INSERT + after_u[0], "I")
    return min(bare[START], first), min(bare[AFTER_S], first), after_u, after_a


NEVER = 1 << 60
#: Nothing is left: fine at the start and after an assistant.
END: Node = _with_insertions([(0, ""), (NEVER, ""), (NEVER, ""), (0, "")])


def node(letter: str, rest: Node) -> Node:
    """The node of an ending that is ``letter`` and then the ending of ``rest``."""
    bare = []
    for state in STATES:
        ways = [(DELETE + rest[state][0], "D")]
        if letter != MUST_GO:
            role, more = letter.lower(), TRUNCATED if letter.isupper() else 0
            if (state, role) in KEPT:
                ways.append((more + rest[KEPT[state, role]][0], "K"))
            ways.append((RELABEL + more + rest[MADE[state]][0], "R"))
        bare.append(min(ways))
    return _with_insertions(bare)


def audit(signature: str, nodes: list[Node]) -> str:
    """Edits from the start; ``nodes``: those of the endings of length 0, 1, ..."""
    state, edits = START, []
    for at in range(len(signature) + 1):
        here = nodes[len(signature) - at]
        while here[state][1] == "I":
            edits.append("I")
            state = MADE[state]
        if at < len(signature):
            edit = here[state][1]
            edits.append(edit)
            if edit == "K":
                state = KEPT[state, signature[at].lower()]
            elif edit == "R":
                state = MADE[state]
    return "".join(edits)


def _walked(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signatures by endings, in order, to (signature, cost, audit, new_nodes)."""
    before, nodes = "", [END]
    for batch in rows:
        found = []
        for backwards in batch.column(0).to_pylist():
            shared = 0
            for a, b in zip(before, backwards):
                if a != b:
                    break
                shared += 1
            del nodes[shared + 1 :]
            for letter in backwards[shared:]:
                nodes.append(node(letter, nodes[-1]))
            before, signature = backwards, backwards[::-1]
            found.append(
                (signature, nodes[-1][START][0], audit(signature, nodes), len(signature) - shared)
            )
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
        columns = list(zip(*found)) or [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds)],
            names=["signature", "cost", "audit", "new_nodes"],
        )


def plans(signatures: DataFrame) -> DataFrame:
    """(signature, cost, audit, new_nodes) for every distinct ``signature``.

    ``new_nodes`` are those that were made for it; the others it shares with signatures before.
    """
    backwards = signatures.select(F.reverse("signature").alias("backwards")).distinct()
    dealt = backwards.repartitionByRange("backwards").sortWithinPartitions("backwards")
    return dealt.mapInArrow(
        _walked, "signature string, cost bigint, audit string, new_nodes bigint"
    )


# --- Conversations --------------------------------------------------------------------------


class _Sequence:
    """What is known of the conversation that is being read."""

    def __init__(self, key):
        self.key, self.faults, self.illegal = key, np.zeros(4, np.int64), 0
        self.first_turn = self.last_turn = self.role = None
        self.turns, self.signature = 0, bytearray()

    def add(self, turns: np.ndarray, symbols: np.ndarray) -> None:
        roles = symbols >> 2
        self.faults += np.bincount(symbols & 3, minlength=4)
        if self.role is not None:
            self.illegal += not LEGAL_PAIR[self.role, roles[0]]
        self.illegal += int(np.count_nonzero(~LEGAL_PAIR[roles[:-1], roles[1:]]))
        self.role = roles[-1]
        if len(turns):
            self.turns += int(np.count_nonzero(np.diff(turns))) + (turns[0] != self.last_turn)
            if self.first_turn is None:
                self.first_turn = int(turns[0])
            self.last_turn = int(turns[-1])
        self.signature += LETTERS[symbols].tobytes()

    def row(self) -> tuple:
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        _, blank, duplicate, short = map(int, self.faults)
        return self.key, gaps, blank, duplicate, short, int(self.illegal), self.signature.decode()


def _sequences(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (conv_id, turn, symbol) to a row for each conversation."""
    now, kind = None, None

    def out(done: list[_Sequence]) -> pa.RecordBatch:
        columns = list(zip(*[s.row() for s in done])) or [[]] * 7
        kinds = (kind, *[pa.int64()] * 5, pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            names=["conv_id", *SUMMARY[:5], "signature"],
        )

    for batch in rows:
        done, kind = [], batch.column(0).type
        keys = batch.column(0).to_pylist()
        known = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
        turns = batch.column(1).fill_null(0).to_numpy()
        symbols = batch.column(2).to_numpy()
        starts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
        for a, b in zip(starts, [*starts[1:], len(keys)]):
            if now is None or now.key != keys[a]:
                if now is not None:
                    done.append(now)
                now = _Sequence(keys[a])
            now.add(turns[a:b][known[a:b]], symbols[a:b])
        yield out(done)
    if now is not None:
        yield out([now])


#: Order of a conversation's rows. Rows of one turn go by role, then by the digest of the text.
ORDER = (F.asc_nulls_first, "turn"), (F.asc, "role"), (F.asc, "digest")


def _order() -> list[Column]:
    return [way(name) for way, name in ORDER]


def _rows(conversations: DataFrame) -> DataFrame:
    """Rows without nulls in what is said, with the digest that stands for the text."""
    text = F.coalesce("text", F.lit(" "))
    return conversations.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        text.alias("text"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )


def sequences(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, signature) of ``_rows``.

    Texts are not moved for it, only their digests.
    """
    trimmed = F.rtrim("text", F.lit(SPACES))
    narrow = rows.select(
        "conv_id",
        "turn",
        "role",
        "digest",
        (trimmed == "").alias("blank"),
        (~F.right(trimmed, F.lit(1)).isin(*ENDS)).alias("short"),
    )
    same = Window.partitionBy("conv_id", "role", "digest").orderBy(F.asc_nulls_first("turn"))
    fault = (
        F.when(F.col("blank"), BLANK)
        .when(F.row_number().over(same) > 1, DUPLICATE)
        .when(F.col("short"), CUT_SHORT)
        .otherwise(CLEAN)
    )
    initial = F.substring("role", 1, 1)
    who = F.lit(len(ROLES))
    for at, letter in enumerate(ROLES):
        who = F.when(initial == letter, at).otherwise(who)
    coded = narrow.withColumn("symbol", (4 * who + fault).cast("int"))
    # By name and with a number of partitions: rows of one conversation go through one task.
    sorted_rows = coded.repartition("conv_id").sortWithinPartitions("conv_id", *_order())
    kind = rows.schema["conv_id"].dataType.simpleString()
    return sorted_rows.select("conv_id", "turn", "symbol").mapInArrow(
        _sequences,
        f"conv_id {kind}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
        "illegal bigint, signature string",
    )


def _planned(found: DataFrame) -> DataFrame:
    """Sequences with ``cost`` and ``audit``. Many may share a signature, so the plans are sent
    to all of them if they are few and short, else to every share of a signature's sequences."""
    made = cut(plans(found)).drop("new_nodes")
    size = made.agg(
        F.count("*").alias("n"), F.sum(F.length("signature") + F.length("audit")).alias("letters")
    ).first()
    if size["n"] <= BROADCAST_ROWS and (size["letters"] or 0) <= BROADCAST_LETTERS:
        return found.join(F.broadcast(made), "signature")
    shares = F.sequence(F.lit(0), F.lit(SALTS - 1))
    salted = found.withColumn("_share", F.pmod(F.xxhash64("conv_id"), F.lit(SALTS)).cast("int"))
    return salted.join(
        made.withColumn("_share", F.explode(shares)), ["signature", "_share"]
    ).drop("_share")


class _Repair:
    """Rows of one conversation, edited one by one as its audit says."""

    def __init__(self, edits: str):
        self.edits, self.at, self.state = edits, 0, START

    def _made(self, text: str) -> tuple[str, str]:
        role = MADE_ROLE[self.state]
        self.state = MADE[self.state]
        return role, text

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            self.at += 1
            yield self._made("")

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        edit = self.edits[self.at]
        self.at += 1
        if edit == "K":
            self.state = KEPT[self.state, role[0]]
            yield role, text
        elif edit == "R":
            yield self._made(text)


def _repaired(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Batches, each with what happens in it: ("begin", place), ("row", role, text), ("end",).

    The first row of a conversation is its plan: the audit in place of a text.
    """
    repair = None
    for batch in rows:
        events = []
        plan = batch.column(1).to_pylist()
        roles, texts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        for at, (is_plan, role, text) in enumerate(zip(plan, roles, texts)):
            if is_plan:
                if repair is not None:
                    events += [("row", *r) for r in repair.inserted()]
                    events.append(("end",))
                repair = _Repair(text)
                events.append(("begin", at))
            else:
                events += [("row", *r) for r in repair.row(role, text)]
        yield batch, events
    if repair is not None:
        yield None, [*[("row", *r) for r in repair.inserted()], ("end",)]


def _as_rows(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, kind, position = None, None, 0
    for batch, events in _repaired(rows):
        keys = batch.column(0) if batch is not None else None
        kind, out = keys.type if batch is not None else kind, []
        for event in events:
            if event[0] == "begin":
                key, position = keys[event[1]].as_py(), 0
            elif event[0] == "row":
                out.append((key, position, *event[1:]))
                position += 1
        columns = list(zip(*out)) or [[]] * 4
        kinds = (kind, pa.int64(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            names=["conv_id", "position", "role", "text"],
        )


def _as_digests(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", *SUMMARY, "audit", "repaired_sha256"]
    key, kinds, facts, begun, digest = None, None, None, False, None
    for batch, events in _repaired(rows):
        out = []
        if batch is not None:
            kinds = (batch.column(0).type, *[pa.int64()] * 6, pa.string(), pa.string())
        for event in events:
            if event[0] == "begin":
                key = batch.column(0)[event[1]].as_py()
                facts = batch.column(4)[event[1]].as_py()
                facts["audit"] = batch.column(3)[event[1]].as_py()
                begun, digest = False, hashlib.sha256()
            elif event[0] == "row":
                digest.update(f"{chr(10) if begun else ''}{event[1]}:{event[2]}".encode())
                begun = True
            else:
                out.append((key, *[facts[n] for n in names[1:-1]], digest.hexdigest()))
        columns = list(zip(*out)) or [[]] * len(names)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=names
        )


def _edited(conversations: DataFrame, end: Callable, schema: str) -> DataFrame:
    rows = _rows(conversations)
    planned = _planned(cut(sequences(rows)))
    facts = F.struct(*SUMMARY)
    heads = planned.select(
        "conv_id",
        F.lit(True).alias("is_plan"),
        F.lit(None).cast("bigint").alias("turn"),
        F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("binary").alias("digest"),
        F.col("audit").alias("text"),
        facts.alias("facts"),
    )
    said = rows.select(
        "conv_id",
        F.lit(False).alias("is_plan"),
        "turn",
        "role",
        "digest",
        "text",
        F.lit(None).cast(heads.schema["facts"].dataType).alias("facts"),
    )
    in_order = (
        heads.union(said)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", F.desc("is_plan"), *_order())
        .select("conv_id", "is_plan", "role", "text", "facts")
    )
    kind = conversations.schema["conv_id"].dataType.simpleString()
    return in_order.mapInArrow(end, f"conv_id {kind}, {schema}")


def repaired(conversations: DataFrame) -> DataFrame:
    """(conv_id, position, role, text): the rows of every conversation after its edits."""
    return _edited(conversations, _as_rows, "position bigint, role string, text string")


def report(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of
    every conversation in rows of (conv_id, turn, role, text).

    Rows are taken by turn, those without one first; rows of one turn by role and then by the
    SHA-256 of their text, so equal rows stand beside each other. A role or text that is null
    counts as one space. Rows without a conversation are one conversation. A conversation of
    which nothing stays has the digest of nothing. No rows give no rows; other columns are not
    looked at.
    """
    columns = ", ".join(f"{name} bigint" for name in SUMMARY)
    return _edited(conversations, _as_digests, f"{columns}, audit string, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with rows dropped, emptied, cut, repeated or given to the user, by the
    CRC-32 of conversation and turn."""

    def said(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    harm = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    text = (
        F.when(F.col("_harm") == 1, F.lit(""))
        .when(F.col("_harm") == 2, F.translate("text", "".join(ENDS), ""))
        .otherwise(F.col("text"))
    )
    rows = conversations.select(
        "conv_id", "turn", said("role").alias("role"), said("text").alias("text"),
        harm.alias("_harm"),
    ).where("_harm <> 0")
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("_harm") == 3, 2).otherwise(1)))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("_harm") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        times.alias("_again"),
    ).drop("_again")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation of the table, damaged and repaired."""
    original = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    found = report(damaged(original)).alias("f")
    every = original.select("conv_id").distinct().alias("e")
    joined = every.join(found, F.col("e.conv_id").eqNullSafe(F.col("f.conv_id")), "left")
    return joined.select(
        "e.conv_id",
        *[F.coalesce(f"f.{name}", F.lit(0).cast("bigint")).alias(name) for name in SUMMARY],
        F.coalesce("f.audit", F.lit("")).alias("audit"),
        F.coalesce("f.repaired_sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256"),
    )
