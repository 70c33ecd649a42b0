"""Chat formatting: a finite-state machine over roles, driven by a declarative template.

A ``Template`` lists the steps of the machine: in a state, a role leads to another state and its text is written between a
prefix and a suffix.  ``formatted`` gives each turn three segments (prefix, text, suffix) with a loss flag each; only the
texts of the trained roles are under the loss.  A turn for which the state has no step is out of order: it is kept, between
the template's general marks that name its role, and the conversation is reported as not valid.  The machine goes on in
the state that its role leads to.

Control strings of the template that stand in a text are escaped: a backslash goes in behind the first character of
``<``, any number of backslashes, and the rest of a control string, so that no text holds a control string and taking one
backslash out again gives the text back exactly.  ``read_back`` parses the segments' text alone, with the same machine.

A conversation may be longer than a task should take.  Turns are range-partitioned by (conversation, turn); each partition
keeps, for its first conversation, the state before each turn for every state that the partition may be entered with; the
entry states follow from one row for each partition, folded in order on the driver (bounded by the number of partitions).
Reading back streams over the sorted turns of a conversation and holds one turn at a time: a digest over a whole conversation is
one pass by its nature, but needs no memory that grows with it.

Defined cases: a null text is empty; a null role is a role that no step knows and reads back as null (the digest has it
empty); a null conversation is one conversation; null turns come first; turns of one number are ordered by role and by a
hash of their text, so the order only leaves open which of two equal turns is first; an empty table gives an empty result.  Other
columns are not read and may have any name.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from urllib.parse import unquote_plus

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalis.llm.scratch import map_arrow, written

_MARK = "<<TURN"
_MARK_END = "\n<</TURN>>"


@dataclass(frozen=True)
class Step:
    state: str
    role: str
    to: str
    prefix: str
    suffix: str


@dataclass(frozen=True)
class Template:
    """``controls``: the strings that no text may hold; none begins inside another one."""

    start: str
    final: frozenset[str]
    steps: tuple[Step, ...]
    trained: frozenset[str]
    controls: tuple[str, ...]

    @cached_property
    def states(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys([self.start, *(x for s in self.steps for x in (s.state, s.to))]))

    @cached_property
    def table(self) -> dict[tuple[str, str], Step]:
        return {(s.state, s.role): s for s in self.steps}

    @cached_property
    def leads(self) -> dict[str, str]:
        """Where a role leads when it is out of order."""
        return {s.role: s.to for s in reversed(self.steps)}

    @cached_property
    def rest(self) -> str:
        """Pattern of a control string's first character, with a group for what follows any backslashes."""
        heads: dict[str, list[str]] = {}
        for c in sorted({*self.controls, _MARK, _MARK_END.strip()}):
            heads.setdefault(c[0], []).append(re.escape(c[1:]))
        return "|".join(rf"{re.escape(h)}%s(?=\\*(?:{'|'.join(tails)}))" for h, tails in heads.items())

    def after(self, state: str, role: str | None) -> str:
        step = self.table.get((state, role))
        return step.to if step else self.leads.get(role, state)

    def escaped(self, text: Column) -> Column:
        return F.regexp_replace(text, self.rest.replace("%s", ""), r"$0\\")

    def unescaped(self, text: str) -> str:
        return self._taken_out.sub(lambda m: m.group()[:1], text)

    @cached_property
    def _taken_out(self) -> re.Pattern:
        return re.compile(self.rest.replace("%s", r"\\"))

    def parse(self, text: str, at: int, state: str) -> tuple[str | None, str, int] | None:
        """Role and text of the turn that begins at ``at``, and where it ends; None if ``text`` does not hold all of it."""
        if text.startswith(_MARK, at):
            head = text.find(">>\n", at)
            end = text.find(_MARK_END, head + 2) if head >= 0 else -1
            if end < 0:
                return None
            name = text[at + len(_MARK) : head]
            return unquote_plus(name[1:]) if name else None, self.unescaped(text[head + 3 : end]), end + len(_MARK_END)
        for s in sorted((s for s in self.steps if s.state == state), key=lambda s: -len(s.prefix)):
            if text.startswith(s.prefix, at):
                begin = at + len(s.prefix)
                end = text.find(s.suffix, begin)
                return None if end < 0 else (s.role, self.unescaped(text[begin:end]), end + len(s.suffix))
        return None


#: Instructions in brackets, the system text inside the first one, each answer closed by an end mark.
INST = Template(
    start="start",
    final=frozenset({"answered"}),
    steps=(
        Step("start", "user", "asked", "<s>[INST] ", " [/INST]"),
        Step("answered", "user", "asked", "<s>[INST] ", " [/INST]"),
        Step("start", "system", "told", "<s>[INST] <<SYS>>\n", "\n<</SYS>>\n\n"),
        Step("told", "user", "asked", "", " [/INST]"),
        Step("asked", "assistant", "answered", " ", " </s>"),
    ),
    trained=frozenset({"assistant"}),
    controls=("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"),
)


def _walked(turns: DataFrame, template: Template) -> DataFrame:
    """Rows part, place, key, role, text, states: the state before the turn, one for each state that the partition may be entered
    with, or a single one where the conversation begins in the partition."""
    kind = turns.schema["key"].dataType
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("place", T.LongType()), T.StructField("key", kind), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()), T.StructField("states", T.ArrayType(T.StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, last = TaskContext.get().partitionId(), 0, object()
        states: tuple[str, ...] = template.states
        first = True
        for batch in batches:
            before = []
            for key, role in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not first and key != last:
                    states = (template.start,)
                first, last = False, key
                before.append(states)
                states = tuple(template.after(s, role) for s in states)
            n = len(batch)
            yield pa.RecordBatch.from_arrays([pa.array([part] * n, pa.int32()), pa.array(range(place, place + n), pa.int64()), *batch.columns, pa.array(before, pa.list_(pa.string()))], names=schema.fieldNames())
            place += n

    by = ["key", "turn", "role", "__hash", "__salt"]
    salted = turns.withColumn("__hash", F.xxhash64("text")).withColumn("__salt", F.monotonically_increasing_id())
    return map_arrow(salted.repartitionByRange(*by).sortWithinPartitions(*by).select("key", "role", "text"), run, schema)


def _entries(walked: DataFrame, template: Template) -> dict[int, int]:
    """For each partition, which of its states hold: the number of the state that it is entered with."""
    ends = walked.groupBy("part").agg(F.min_by("key", "place").alias("first"), F.max_by(F.struct("key", "role", "states"), "place").alias("last"))
    entry, held, known, out = template.start, None, False, {}
    for r in sorted(ends.collect(), key=lambda r: r["part"]):  # one row a partition
        if not known or r["first"] != held:
            entry = template.start
        out[r["part"]] = template.states.index(entry)
        states = r["last"]["states"]
        entry = template.after(states[out[r["part"]]] if len(states) > 1 else states[0], r["last"]["role"])
        held, known = r["last"]["key"], True
    return out


def formatted(turns: DataFrame, template: Template = INST, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per turn, ordered within its conversation by (part, place): key, part, place, state (after it), in_order and
    segments, an array of (text, loss)."""
    spark = turns.sparkSession
    chosen = turns.select(F.col(key).alias("key"), F.col(role).alias("role"), F.coalesce(text, F.lit("")).alias("text"), F.col(turn).alias("turn"))
    walked = written(_walked(chosen, template), "turns")
    entries = spark.createDataFrame(list(_entries(walked, template).items()), "part int, entry int")
    rows = walked.join(F.broadcast(entries), "part").withColumn("before", F.when(F.size("states") > 1, F.col("states")[F.col("entry")]).otherwise(F.col("states")[0]))

    def choose(value, other: Column) -> Column:
        out = None
        for s in template.steps:
            hit = (F.col("before") == s.state) & (F.col("role") == s.role)
            out = F.when(hit, F.lit(value(s))) if out is None else out.when(hit, F.lit(value(s)))
        return out.otherwise(other)

    named = F.concat(F.lit(_MARK), F.coalesce(F.concat(F.lit(" "), F.url_encode("role")), F.lit("")), F.lit(">>\n"))
    after = F.col("before")
    for name, state in template.leads.items():
        after = F.when(F.col("role") == name, F.lit(state)).otherwise(after)
    segments = [
        (choose(lambda s: s.prefix, named), F.lit(False)),
        (template.escaped(F.col("text")), F.coalesce(F.col("role").isin(sorted(template.trained)), F.lit(False))),
        (choose(lambda s: s.suffix, F.lit(_MARK_END)), F.lit(False)),
    ]
    return rows.select("key", "part", "place", choose(lambda s: s.to, after).alias("state"), choose(lambda s: True, F.lit(False)).alias("in_order"), F.array(*(F.struct(t.alias("text"), on.alias("loss")) for t, on in segments)).alias("segments"))


def read_back(rows: DataFrame, template: Template = INST) -> DataFrame:
    """One row per conversation from the output of ``formatted``: key, n_turns, turns_sha256 (role, newline, text, newline for each
    turn), loss_chars and loss_sha256 (the text under the loss), formatted_chars, valid (every turn in order, ended in a final
    state).  ValueError where the text cannot be read."""
    schema = T.StructType([T.StructField("key", rows.schema["key"].dataType), *(T.StructField(n, k) for n, k in (("n_turns", T.LongType()), ("turns_sha256", T.StringType()), ("loss_chars", T.LongType()), ("loss_sha256", T.StringType()), ("formatted_chars", T.LongType()), ("valid", T.BooleanType())))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def read() -> Iterator[None]:
            """Takes (text, loss) pieces of one conversation; None ends it."""
            held, state, valid = "", template.start, True
            turns, loss, n_turns, n_loss, n_chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            while (got := (yield)) is not None:
                for piece, on in got:
                    n_chars += len(piece)
                    held += piece
                    if on:
                        plain = template.unescaped(piece)
                        n_loss += len(plain)
                        loss.update(plain.encode())
                at = 0
                while at < len(held) and (found := template.parse(held, at, state)):
                    role, text, at = found
                    turns.update(f"{role or ''}\n{text}\n".encode())
                    valid = valid and (state, role) in template.table
                    state = template.after(state, role)
                    n_turns += 1
                held = held[at:]
            if held:
                raise ValueError("text that the template cannot have written")
            out.append((n_turns, turns.hexdigest(), n_loss, loss.hexdigest(), n_chars, valid and state in template.final))

        keys, reader, last = [], None, None

        def close() -> None:
            try:
                reader.send(None)
            except StopIteration:
                keys.append(last)

        for batch in batches:
            found = batch.column(1)
            for i, key in enumerate(batch.column(0).to_pylist()):
                if reader is None or key != last:
                    if reader is not None:
                        close()
                    reader, last = read(), key
                    next(reader)
                reader.send([(s["text"], s["loss"]) for s in found[i].as_py()])
            if len(keys) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(keys, batch.column(0).type), *map(pa.array, zip(*out, strict=True))], names=schema.fieldNames())
                keys, out[:] = [], []
        if reader is not None:
            close()
            yield pa.RecordBatch.from_arrays([pa.array(keys, batch.column(0).type), *map(pa.array, zip(*out, strict=True))], names=schema.fieldNames())

    ordered = rows.repartition("key").sortWithinPartitions("key", "part", "place")
    return map_arrow(ordered.select("key", "segments"), run, schema)
