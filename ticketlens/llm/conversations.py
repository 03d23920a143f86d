"""Repair of damaged conversations by the cheapest edits (see ``lattice``).

``repair`` takes rows (conversation, turn, role, text) in the order of turn,
NULL turns first, then role and text.  A row's first fault counts: blank (no
character but white space), duplicate (its role and text stood earlier in the
conversation), truncated (the last such character is none of ``.!?``).

How it scales.  Equal rows are counted before anything else, so a row that
stands a billion times is one row with a count, and its copies are Deletes
behind it.  The rows are then dealt over the tasks by ranges of (conversation,
turn, role, beginning of the text), not by conversation, so a conversation
with a third of all rows lies in many files, and no task gathers one.  Each
file is solved by itself but for its first and last conversation, which may go
on in a neighbouring file: of those a summary of fixed size (least costs per
pair of states, order of the ways) goes to the driver, at most two per file,
which settles the states between the files.  A second pass then knows where
each stretch starts and ends.  Whole texts are read at every size.

What grows with one conversation is what its result holds: its audit is one
text, and its hash one running hash, taken in order by one task that holds one
batch of lines at a time.

NULL ids, roles and texts: a NULL role or text is one space; NULL
conversation ids form one conversation; NULL turns come first and count in no
gap.  A role that is empty can't be kept.  Extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.llm import lattice
from ticketlens.llm.common import ready_workers, save

BLANK, DUPLICATE, TRUNCATED, SOUND = "blank", "duplicate", "truncated", "sound"
LEGAL = ("su", "ua", "au")
GAP = "\\x20\\x09-\\x0D"
BROADCAST_AGAIN = 100_000  # texts that stand at several turns: some 15 MB
RANGE_CHARS = 32  # of a text that take part in dealing the rows; sorting reads whole texts
SOLVED_SCHEMA = "conv_id long, place long, k long, role string, text string, audit string, cost long, illegal long"
DIGEST_SCHEMA = "conv_id long, repaired_sha256 string"


def conversation_rows(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """conv_id, turn, role, text; a NULL role or text is one space."""
    return rows.select(
        rows[conv_col].cast("long").alias("conv_id"),
        rows[turn_col].cast("long").alias("turn"),
        F.coalesce(rows[role_col].cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(rows[text_col].cast("string"), F.lit(" ")).alias("text"),
    )


def damage(rows: DataFrame) -> DataFrame:
    """Rows of ``conversation_rows`` with a fault in five of twenty, by the checksum of conversation and turn."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(1), F.when(kind == 3, 2).otherwise(1)))
    return rows.where(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def placed_rows(rows: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies, fault and place in the order of all rows; a saved table.

    Places are consecutive inside a file; ``place`` grows with
    (conv_id, turn, role, text).
    """
    counted = save(rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies")), "conversations-counted")
    blank = ~F.col("text").rlike(f"[^{GAP}]")
    counted = counted.select("*", blank.alias("blank"), F.struct(F.col("turn").isNotNull(), "turn").alias("at"))
    digest = F.sha2(F.col("text").cast("binary"), 256)
    # what stands at several turns: the first one is no duplicate; sound tables have few of them
    again = counted.where(~blank).groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), digest.alias("d"))
    again = save(again.agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "conversations-again")
    if again.count() <= BROADCAST_AGAIN:
        again = F.broadcast(again)  # the texts stay where they are; beyond the bound the join shuffles
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (digest == F.col("d"))
    fault = (
        F.when(F.col("blank"), BLANK)
        .when(F.col("at") > F.col("first"), DUPLICATE)
        .when(~F.col("text").rlike(f"[.!?][{GAP}]*\\z"), TRUNCATED)
        .otherwise(SOUND)
    )
    order = ["conv_id", "turn", "role"]
    dealt = (
        counted.join(again, same, "left")
        .select(*order, "text", "copies", fault.alias("fault"))
        .repartitionByRange(*order, F.substring("text", 1, RANGE_CHARS))
        .sortWithinPartitions(*order, "text")
    )
    return save(dealt.withColumn("place", F.monotonically_increasing_id()), "conversations-placed")


def conversation_counts(placed: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated; hot conversations are summed per turn first."""
    first_is = lambda fault: F.when(F.col("fault") == fault, 1).otherwise(0)
    again = F.when(F.col("fault") == BLANK, 0).when(F.col("fault") == DUPLICATE, F.col("copies")).otherwise(F.col("copies") - 1)
    per_turn = placed.groupBy("conv_id", "turn").agg(
        F.sum(F.when(F.col("fault") == BLANK, F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(again).alias("duplicate"),
        F.sum(first_is(TRUNCATED)).alias("truncated"),
    )
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return per_turn.groupBy("conv_id").agg(
        F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), *[F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated")]
    )


@dataclass
class Stretch:
    """Neighbouring rows of one conversation in one file."""

    conv_id: int | None
    rows: list[tuple]  # place, role, text or None, copies, fault
    is_border: bool = False  # the conversation may go on in another file

    @property
    def place(self) -> int:
        return self.rows[0][0]

    def steps(self) -> list[lattice.Step]:
        return [(role[:1], fault == TRUNCATED, fault in (BLANK, DUPLICATE)) for _, role, _, _, fault in self.rows]

    def illegal(self) -> int:
        firsts = [role[:1] for _, role, *_ in self.rows]
        inside = sum(a + b not in LEGAL for a, b in zip(firsts, firsts[1:]))
        return inside + sum(copies - 1 for *_, copies, _ in self.rows)  # no role may follow itself

    def deleted_copies(self, k: int) -> int:
        """Copies of row k that go whatever becomes of the row itself."""
        return self.rows[k][3] - 1


def stretches(batches: Iterable[pa.RecordBatch], with_text: bool) -> Iterator[Stretch]:
    """The stretches of a task's rows, one at a time; the first and last of every run of places are borders."""
    now: Stretch | None = None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "copies", "fault")]
        texts = batch.column("text").to_pylist() if with_text else [None] * batch.num_rows
        for conv, place, role, copies, fault, text in zip(*columns, texts):
            follows = now is not None and place == now.rows[-1][0] + 1
            if not follows or conv != now.conv_id:
                if now is not None:
                    now.is_border |= not follows
                    yield now
                now = Stretch(conv, [], not follows)
            now.rows.append((place, role, text, copies, fault))
    if now is not None:
        now.is_border = True
        yield now


@dataclass(frozen=True)
class Between:
    """What a border stretch gets from its neighbours."""

    entry: int
    exits: lattice.Exits
    illegal: int  # whether the step from the stretch before it is illegal


def border_states(placed: DataFrame) -> dict[int, Between]:
    """By first place: the states around every stretch of a conversation that lies in several files.

    Collects at most two rows of fixed size per file of ``placed``.
    """
    schema = "conv_id long, place long, first string, last string, way array<struct<p: int, q: int, cost: long, rank: int>>"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for s in stretches(batches, with_text=False):
            if s.is_border:
                summary = lattice.stretch_summary(s.steps())
                way = [{"p": p, "q": q, "cost": c, "rank": summary.rank[p, q]} for (p, q), c in summary.cost.items()]
                found.append({"conv_id": s.conv_id, "place": s.place, "first": s.rows[0][1][:1], "last": s.rows[-1][1][:1], "way": way})
        if found:
            way_type = pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("rank", pa.int32())]))
            types = [("conv_id", pa.int64()), ("place", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("way", way_type)]
            yield pa.RecordBatch.from_pylist(found, pa.schema(types))

    rows = placed.select("conv_id", "place", "role", "copies", "fault").mapInArrow(run, schema).collect()
    of: dict[int | None, list] = {}
    for r in sorted(rows, key=lambda r: r["place"]):
        of.setdefault(r["conv_id"], []).append(r)
    known = {}
    for parts in of.values():
        summaries = [
            lattice.Summary({(w["p"], w["q"]): w["cost"] for w in r["way"]}, {(w["p"], w["q"]): w["rank"] for w in r["way"]}) for r in parts
        ]
        _, states = lattice.states_between(summaries, lattice.START, lattice.TAIL)
        for k, r in enumerate(parts):
            exits = lattice.TAIL if k == len(parts) - 1 else {states[k + 1]: (0, "")}
            step = k > 0 and parts[k - 1]["last"] + r["first"] not in LEGAL
            known[r["place"]] = Between(states[k], exits, int(step))
    return known


def solved(placed: DataFrame) -> DataFrame:
    """One row per stretch (audit, cost, illegal; k NULL) and one per repaired line (role, text; k its place in the stretch)."""
    spark = placed.sparkSession
    ready_workers(spark)
    shared = spark.sparkContext.broadcast(border_states(placed))  # at most two entries per file

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for s in stretches(batches, with_text=True):
            if s.is_border:
                between = shared.value[s.place]
            else:
                between = Between(lattice.START, lattice.TAIL, 0)
            cost, letters = lattice.repair(s.steps(), between.entry, between.exits)
            audit, lines, state, k = [], [], between.entry, 0
            for letter in letters:
                audit.append(letter)
                if letter == "I":
                    state = lattice.AFTER[state]
                    lines.append((lattice.ROLE[state], ""))
                    continue
                _, role, text, _, _ = s.rows[k]
                if letter == "K":
                    state = lattice.KEPT[state, role[:1]]
                    lines.append((role, text))
                elif letter == "R":
                    state = lattice.AFTER[state]
                    lines.append((lattice.ROLE[state], text))
                extra = s.deleted_copies(k)
                audit.append("D" * extra)
                cost += lattice.DELETE * extra
                k += 1
            head = {"conv_id": s.conv_id, "place": s.place, "audit": "".join(audit), "cost": cost, "illegal": s.illegal() + between.illegal}
            out.append(head)
            for k, (role, text) in enumerate(lines):
                out.append({"conv_id": s.conv_id, "place": s.place, "k": k, "role": role, "text": text})
                size += len(text)
                if size > 1 << 22:
                    yield batch_of(out)
                    out, size = [], 0
            if len(out) > 10_000:
                yield batch_of(out)
                out, size = [], 0
        if out:
            yield batch_of(out)

    return save(placed.mapInArrow(run, SOLVED_SCHEMA), "conversations-solved")


_TYPES = pa.schema(
    [(c, pa.int64()) for c in ("conv_id", "place", "k")]
    + [(c, pa.string()) for c in ("role", "text", "audit")]
    + [(c, pa.int64()) for c in ("cost", "illegal")]
)


def batch_of(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{c: r.get(c) for c in _TYPES.names} for r in rows], _TYPES)


@dataclass(frozen=True)
class Repaired:
    """``lines``: conv_id, place, k (their order), role, text of the repaired rows; ``reports``: one row per conversation."""

    lines: DataFrame
    reports: DataFrame


def repair(rows: DataFrame) -> Repaired:
    """Cheapest repair of rows as ``conversation_rows`` gives them."""
    ready_workers(rows.sparkSession)
    placed = placed_rows(rows)
    found = solved(placed)
    heads = found.where("k IS NULL").groupBy("conv_id").agg(
        F.sum("illegal").alias("illegal"),
        F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "audit"))), lambda x: x["audit"]), "").alias("audit"),
    )
    counts = conversation_counts(placed)
    reports = counts.join(heads.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    return Repaired(found.where("k IS NOT NULL").select("conv_id", "place", "k", "role", "text"), reports)


def line_digests(lines: DataFrame) -> DataFrame:
    """conv_id, SHA-256 of its lines ``role:text`` joined by line feeds, taken in order as the rows stream by."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, begun = None, None, False
        for batch in batches:
            ids, digests = [], []
            for conv, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not begun or conv != now:
                    if begun:
                        ids.append(now)
                        digests.append(state.hexdigest())
                    now, state, begun = conv, hashlib.sha256(line.encode("utf-8", "surrogatepass")), True
                else:
                    state.update(b"\n" + line.encode("utf-8", "surrogatepass"))
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(digests, pa.string())], ["conv_id", "repaired_sha256"])
        if begun:
            yield pa.record_batch([pa.array([now], pa.int64()), pa.array([state.hexdigest()])], ["conv_id", "repaired_sha256"])

    ordered = lines.repartition("conv_id").sortWithinPartitions("conv_id", "place", "k")
    return ordered.select("conv_id", F.concat_ws(":", "role", "text").alias("line")).mapInArrow(run, DIGEST_SCHEMA)


def repair_table(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows``: its rows are damaged, then repaired."""
    whole = conversation_rows(rows)
    repaired = repair(damage(whole))
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    parts = whole.select("conv_id").distinct()
    for part in (repaired.reports, line_digests(repaired.lines)):
        parts = parts.unionByName(part, allowMissingColumns=True)
    return parts.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
