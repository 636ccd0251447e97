"""Conversation structure repair: cheapest edits to the grammar ``(s?(ua)+)?``.

Rows (conversation, turn, role, text) are taken in the order of their turn, null
turns first; rows that share a turn go by role and then by the SHA-256 of their
text. A row's first fault counts: blank (its text holds nothing but blanks),
duplicate (the conversation has the same role and text before it), truncated
(its last character that is no blank is none of ``.!?``). Blank and duplicate
rows must go. Turns are aligned to the grammar by ``turn_alignment``; the audit
names the edits in order: Keep, Rerole, Delete, Insert (an empty text).

Rows are dealt to tasks by ranges of that order, so a conversation with a third
of all rows lies over many tasks. A conversation that lies whole within one
range and holds at most ``WHOLE_TURNS`` rows and ``WHOLE_BYTES`` of text is
repaired as it streams by. The others (two a task at most, and the large
ones) go on as they are: a narrow job marks their faults, tasks turn runs of
``RUN`` turns into matrices of cheapest alignments between the states of the
grammar, those of a conversation are joined (one letter a turn and state passes
through that task, as the audit is one value), and the runs' own parts of the
audit are dealt back to their rows.

Nulls: a null role or text counts as one space (so the row is blank), a null
conversation id is a conversation of its own. Repeated rows are duplicates.
Empty texts are blank. An empty table gives no rows; conversations whose rows
all went are well formed and have no rows here. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylens.llm import turn_alignment as T
from delaylens.llm.common import small_batches, sorted_groups
from delaylens.session import materialize

WHOLE_TURNS = 20_000
WHOLE_BYTES = 16 << 20
RUN = 1024
ROW_BYTES = 4 << 20
FULL = re.compile(r"[^\x20\x09-\x0D]")
TAIL = re.compile(r"[\x20\x09-\x0D]+\Z")
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
SIGNS = "kind string, conv_id {id}, part int, seq long, turn {turn}, role string, text string, edit string"
COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def damage(rows: DataFrame) -> DataFrame:
    """The faults of the query: by crc32 of ``conv_id:turn`` modulo 20 a row is
    dropped (0), loses its text (1) or its ``.!?`` (2), stands twice (3) or turns user (4)."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    fault, text = F.crc32(key) % 20, F.coalesce("text", F.lit(" "))
    return (rows.select("conv_id", "turn", F.when(fault == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
                        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
                        F.explode(F.when(fault == 0, F.array().cast("array<int>")).when(fault == 3, F.array(F.lit(0), F.lit(0)))
                                  .otherwise(F.array(F.lit(0)))).alias("again")).drop("again"))


def fault_of(text: str) -> str:
    """``B`` blank, ``T`` truncated or nothing."""
    if not FULL.search(text):
        return "B"
    return "" if TAIL.sub("", text)[-1] in ".!?" else "T"


def sign_of(role: str, fault: str) -> str:
    if fault in ("B", "D"):
        return "D"
    kind = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return kind.upper() if fault == "T" else kind


def illegal_pairs(roles: list[str]) -> int:
    return sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles, roles[1:]))


def gaps_of(turns: list) -> int:
    known = {t for t in turns if t is not None}
    return max(known) - min(known) + 1 - len(known) if known else 0


def edited(rows: Iterator[tuple[str, str]], audit: str, first: str) -> Iterator[tuple[str, str, str]]:
    """(role, text, edit) of every turn that stays or is made; ``first`` is the
    role initial that the grammar wants next (``s`` if the audit keeps a system turn first)."""
    want = first
    for edit in audit:
        role, text = next(rows) if edit != "I" else ("", "")
        if edit == "D":
            continue
        yield (role if edit == "K" else ROLES[want]), text, edit
        want = "a" if want == "u" else "u"


def _opening(audit: str) -> str:
    """A well-formed conversation of odd length opens with its system turn."""
    return "s" if (len(audit) - audit.count("D")) % 2 else "u"


def _wanted(opening: str, before: int) -> str:
    """The initial that the grammar wants after so many turns."""
    if opening == "s":
        return "s" if not before else "ua"[(before - 1) % 2]
    return "ua"[before % 2]


def _row(schema: pa.Schema, *values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)


class _Out:
    """Rows of the task, handed over in batches."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, *row) -> None:
        self.rows.append(row)
        self.size += 64 + len(row[6] or "") + len(row[-1] or "")

    def batches(self, full: int = ROW_BYTES) -> Iterator[pa.RecordBatch]:
        if self.rows and self.size >= full:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*self.rows), self.schema)], schema=self.schema)
            self.rows, self.size = [], 0


def _order() -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.sha2("text", 256)]


class Repaired:
    """``turns``: conv_id, part, seq, role, text, edit, one row per turn that stays or is
    made, in order of (part, seq). ``report``: conv_id, the counts of faults, cost and audit."""

    def __init__(self, turns: DataFrame, report: DataFrame):
        self.turns, self.report = turns, report


def repair(rows: DataFrame, whole_turns: int = WHOLE_TURNS, run_turns: int = RUN) -> Repaired:
    rows = rows.select("conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    kinds = {"id": rows.schema["conv_id"].dataType.simpleString(), "turn": rows.schema["turn"].dataType.simpleString()}
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (rows.repartitionByRange(parts, *_order()).sortWithinPartitions(*_order())
             .withColumn("part", F.spark_partition_id()))
    schema = f"{SIGNS}, {COUNTS}".format(**kinds)
    with small_batches(rows.sparkSession):
        seen = materialize(dealt.select("conv_id", "part", "turn", "role", "text").mapInArrow(_stream(schema, whole_turns), schema), "conv-repaired")
        report = [c.split()[0] for c in COUNTS.split(", ")]
        turns = seen.where("kind = 'turn'").select("conv_id", "part", "seq", "role", "text", "edit")
        done = seen.where("kind = 'report'").select("conv_id", *report)
        raw = seen.where("kind = 'raw'").select("conv_id", "part", "seq", "turn", "role", "text")
        more_turns, more_done = _spread(raw, kinds, run_turns)
    return Repaired(turns.unionByName(more_turns), done.unionByName(more_done))


def _arrow(ddl: str) -> pa.Schema:
    """Arrow twin of a schema string."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(ddl))


def _stream(schema: str, whole_turns: int):
    """Sorted rows to repaired turns, reports and rows that must wait."""
    arrow = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(arrow)
        held: list[tuple] = []
        now, first, waits, seq, size, part = None, True, True, 0, 0, 0

        def hand_on() -> None:
            for s, turn, role, text in held:
                out.add("raw", now, part, s, turn, role, text, None, *[None] * 7)
            held.clear()

        def close() -> None:
            faults, met = [], set()
            for _, _, role, text in held:
                fault = fault_of(text)
                if fault != "B":
                    key = hashlib.sha256(f"{role}\0{text}".encode()).digest()
                    fault = "D" if key in met else fault
                    met.add(key)
                faults.append(fault)
            cost, audit = T.repair("".join(sign_of(h[2], f) for h, f in zip(held, faults)))
            lines = edited(((role, text) for _, _, role, text in held), audit, _opening(audit))
            for k, (role, text, edit) in enumerate(lines):
                out.add("turn", now, part, k, None, role, text, edit, *[None] * 7)
            out.add("report", now, part, 0, None, None, None, None, gaps_of([h[1] for h in held]), faults.count("B"),
                    faults.count("D"), faults.count("T"), illegal_pairs([h[2] for h in held]), cost, audit)
            held.clear()

        for batch in batches:
            for conv, part, turn, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if first or conv != now:
                    # the first conversation of a range may have begun in the one before
                    if not waits:
                        close()
                    now, waits, first, size = conv, first, False, 0
                seq += 1
                held.append((seq, turn, role, text))
                size += len(text)
                waits = waits or len(held) > whole_turns or size > WHOLE_BYTES
                if waits:
                    hand_on()
                yield from out.batches()
        hand_on()           # the last may go on in the next range
        yield from out.batches(0)

    return run


def _spread(raw: DataFrame, kinds: dict, run_turns: int) -> tuple[DataFrame, DataFrame]:
    """Turns and reports of the conversations that lie over several tasks or are large."""
    full = F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")
    initial = F.substring("role", 1, 1)
    narrow = materialize(raw.select(
        "conv_id", "part", "seq", "turn", initial.alias("initial"), F.length(F.trim(full)).alias("size"),
        F.unhex(F.sha2(F.concat_ws("\0", "role", "text"), 256)).alias("content"),
        F.substring(F.trim(full), -1, 1).isin(".", "!", "?").alias("ended")), "conv-narrow")
    here = F.struct("part", "seq")
    firsts = (narrow.where("size > 0").groupBy("conv_id", "content").agg(F.min(here).alias("at"))
              .select(F.col("conv_id").alias("c"), F.col("at.part").alias("p"), F.col("at.seq").alias("s")))
    fault = (F.when(F.col("size") == 0, "B").when(F.col("s").isNull(), "D").when(~F.col("ended"), "T").otherwise(""))
    kind = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("x")
    marked = narrow.join(firsts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")) & (F.col("seq") == F.col("s")), "left")
    run = F.floor(F.col("seq") / run_turns).alias("run")
    signs = marked.select("conv_id", "part", run, "seq", "turn", "initial", fault.alias("fault")).withColumn(
        "sign", F.when(F.col("fault").isin("B", "D"), "D").when(F.col("fault") == "T", F.upper(kind)).otherwise(kind))
    parts = int(raw.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["conv_id", "part", "run"]
    sums = ("conv_id {id}, part int, run long, n long, blank long, duplicate long, truncated long, illegal long, "
            "first string, last string, ways array<struct<p:int,q:int,cost:long,audit:string>>").format(**kinds)
    runs_schema = _arrow(sums)

    def to_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in sorted_groups(batches, 3):
            conv, part, at = (g.column(k)[0].as_py() for k in range(3))
            initials, faults, signs_ = (g.column(n).to_pylist() for n in ("initial", "fault", "sign"))
            ways = [{"p": p, "q": q, "cost": c, "audit": a} for (p, q), (c, a) in T.matrix("".join(signs_)).items()]
            yield _row(runs_schema, conv, part, at, len(faults), *(faults.count(f) for f in "BDT"), illegal_pairs(initials),
                       initials[0], initials[-1], ways)

    runs = materialize(signs.repartition(parts, *keys).sortWithinPartitions(*keys, "seq").mapInArrow(to_runs, sums), "conv-runs")
    turns = (narrow.groupBy("conv_id").agg(F.min("turn").alias("low"), F.max("turn").alias("high"), F.count_distinct("turn").alias("n"))
             .select("conv_id", F.coalesce(F.col("high") - F.col("low") + 1 - F.col("n"), F.lit(0)).cast("long").alias("gaps")))
    chosen_ddl = ("conv_id {id}, part int, run long, wants string, piece string, blank long, duplicate long, truncated long, "
                  "illegal long, cost long, audit string").format(**kinds)
    chosen_schema = _arrow(chosen_ddl)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in sorted_groups(batches, 1):
            cols = {n: g.column(n).to_pylist() for n in g.column_names}
            conv = cols["conv_id"][0]
            ways = [{(w["p"], w["q"]): (w["cost"], w["audit"]) for w in ws} for ws in cols["ways"]]
            total = T.join_all([{k: v for k, v in ways[0].items() if k[0] == T.START}, *ways[1:]])
            cost, audit = min(total[T.START, s] for s in (T.START, T.ASSISTANT) if (T.START, s) in total)
            counts = [sum(cols[c]) for c in ("blank", "duplicate", "truncated", "illegal")]
            counts[3] += sum(a + b not in LEGAL for a, b in zip(cols["last"], cols["first"][1:]))
            yield _row(chosen_schema, conv, None, None, None, None, *counts, cost, audit)
            # a run's part of the audit ends with its last turn's edit, the last run's with the audit
            letters = np.frombuffer(audit.encode(), np.uint8)
            ends = np.flatnonzero(letters != ord("I"))[np.cumsum(cols["n"]) - 1] + 1
            ends[-1] = len(letters)
            kept = np.concatenate([[0], np.cumsum(letters != ord("D"))])
            for k, (a, b) in enumerate(zip([0, *ends[:-1]], ends)):
                yield _row(chosen_schema, conv, cols["part"][k], cols["run"][k], _wanted(_opening(audit), int(kept[a])),
                           audit[a:b], *[None] * 6)

    chosen = materialize(runs.repartition(parts, "conv_id").sortWithinPartitions(*keys).mapInArrow(choose, chosen_ddl), "conv-chosen")
    reports = (chosen.where("part is null").alias("r").join(turns.alias("t"), F.col("r.conv_id").eqNullSafe(F.col("t.conv_id")))
               .select("r.conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"))
    plans = chosen.where("part is not null").select("conv_id", "part", "run", F.lit(-1).cast("long").alias("seq"),
                                                    F.col("wants").alias("role"), F.col("piece").alias("text"))
    both = raw.select("conv_id", "part", run, "seq", "role", "text").unionByName(plans)
    out_ddl = "conv_id {id}, part int, seq long, role string, text string, edit string".format(**kinds)
    out_schema = _arrow(out_ddl)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in sorted_groups(batches, 3):
            conv, part, at = (g.column(k)[0].as_py() for k in range(3))
            wants, piece = g.column(4)[0].as_py(), g.column(5)[0].as_py()
            own = ((g.column(4)[k].as_py(), g.column(5)[k].as_py()) for k in range(1, g.num_rows))
            # insertions may outnumber rows: a run's turns are numbered from four times its first row's place on
            rows = [(conv, part, 4 * run_turns * at + k, *r) for k, r in enumerate(edited(own, piece, wants))]
            for a in range(0, len(rows), 256):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[a:a + 256]), out_schema)], schema=out_schema)

    more = both.repartition(parts, *keys).sortWithinPartitions(*keys, "seq").mapInArrow(apply, out_ddl)
    return materialize(more, "conv-more"), reports


def digests(turns: DataFrame) -> DataFrame:
    """Per conversation (conv_id, repaired_sha256): SHA-256 of its repaired ``role:text``
    lines. Lines stream by in order, so a task holds one batch however long a conversation is."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["conv_id", "part", "seq"]
    lines = (turns.select(*keys, F.concat("role", F.lit(":"), "text").alias("line"))
             .repartition(parts, "conv_id").sortWithinPartitions(*keys))
    schema = _arrow(f"conv_id {kind}, repaired_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(3)
            done = []
            for k, conv in enumerate(ids):
                if digest is None or conv != now:
                    if digest is not None:
                        done.append((now, digest.hexdigest()))
                    now, digest = conv, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(texts[k].as_buffer())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
        if digest is not None:
            yield _row(schema, now, digest.hexdigest())

    with small_batches(turns.sparkSession):
        return materialize(lines.mapInArrow(run, f"conv_id {kind}, repaired_sha256 string"), "conv-digests")


def repair_report(conversations: DataFrame, rows: DataFrame, whole_turns: int = WHOLE_TURNS, run_turns: int = RUN) -> DataFrame:
    """Per conversation of ``conversations`` the report over its ``rows`` (what is
    left of them) and the digest of its repaired turns. Without rows: zeros, an
    empty audit and the empty text's digest."""
    done = repair(rows, whole_turns, run_turns)
    names = [c.split()[0] for c in COUNTS.split(", ")]
    all_ids = conversations.select("conv_id").distinct().alias("c")
    r, d = done.report.alias("r"), digests(done.turns).alias("d")
    nothing = hashlib.sha256().hexdigest()
    return (all_ids.join(r, F.col("c.conv_id").eqNullSafe(F.col("r.conv_id")), "left")
            .join(d, F.col("c.conv_id").eqNullSafe(F.col("d.conv_id")), "left")
            .select("c.conv_id", *[F.coalesce(f"r.{n}", F.lit("") if n == "audit" else F.lit(0).cast("long")).alias(n) for n in names],
                    F.coalesce("d.repaired_sha256", F.lit(nothing)).alias("repaired_sha256")))
