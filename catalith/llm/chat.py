"""Chat records of several layouts as canonical turns, in one training format and back.

A record's layout is found by its fingerprint, the hash of its nested field paths
(``messages[].role``).  The fingerprint selects a declarative mapping, which turns prompt,
instruction, message and row-per-turn layouts into turns (conv_id, turn, role, text).
Frames are mapped by their schema, JSON records one by one, so one table may mix layouts.

A template marks the turns.  Control strings inside texts get a backslash after their
first character (one more where some stand there already), which reading takes out again.
Only the texts of assistants lie under the loss mask.

Turns are dealt by ranges of (conv_id, turn), formatted there, and cut into parts of about
``PART`` characters, so one long conversation spreads over many tasks.  Reading parses the
parts in parallel; a digest is a chain over a conversation, so its parts stream through one
task in order, and nothing but the running hash is kept.

Defined results: null texts and roles are empty strings, and a turn with an empty text
stays; equal turn numbers go by role, then by content; repeated rows are repeated turns; a
null conversation id is one conversation; JSON records that do not parse or whose
fingerprint is unknown have null ``turns`` and keep their fingerprint; null elements of a
list are passed over; a frame with fields of several layouts takes the first in the order
of ``LAYOUTS``; other columns, whatever their names, are ignored; an empty table gives no
rows; lone surrogates of JSON escapes are read as the replacement character.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import combinations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from catalith.llm import kernel

PART = 200_000
TURNS = "conv_id long, turn long, role string, text string"
SPEAKERS = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Fixed:
    """One turn of a given role; its text joins the non-empty fields with a blank line."""

    role: str
    fields: tuple[str, ...]


@dataclass(frozen=True)
class Each:
    """One turn for every element of a list field, or for every row where ``items`` is empty."""

    items: str
    role: str
    text: str
    speakers: dict[str, str] = field(default_factory=dict, hash=False)


@dataclass(frozen=True)
class Layout:
    name: str
    rules: tuple[Fixed | Each, ...]
    optional: tuple[str, ...] = ()

    def paths(self) -> list[str]:
        found = []
        for rule in self.rules:
            if isinstance(rule, Fixed):
                found += rule.fields
            else:
                inside = f"{rule.items}[]." if rule.items else ""
                found += [inside + rule.role, inside + rule.text]
        return found

    def variants(self) -> Iterator[list[str]]:
        """The sets of paths that this layout reads, with and without the optional ones."""
        fixed = [p for p in self.paths() if p not in self.optional]
        for n in range(len(self.optional), -1, -1):
            for some in combinations(self.optional, n):
                yield fixed + list(some)


LAYOUTS = (
    Layout("rows", (Each("", "role", "text"),)),
    Layout("messages", (Each("messages", "role", "content"),)),
    Layout("conversations", (Each("conversations", "from", "value", SPEAKERS),)),
    Layout("turns", (Each("turns", "speaker", "text", SPEAKERS),)),
    Layout("instruction", (Fixed("system", ("system",)), Fixed("user", ("instruction", "input")), Fixed("assistant", ("output",))), ("system", "input")),
    Layout("prompt", (Fixed("system", ("system",)), Fixed("user", ("prompt",)), Fixed("assistant", ("completion",))), ("system",)),
    Layout("response", (Fixed("system", ("system",)), Fixed("user", ("prompt",)), Fixed("assistant", ("response",))), ("system",)),
    Layout("question", (Fixed("user", ("context", "question")), Fixed("assistant", ("answer",))), ("context",)),
)


def fingerprint(paths: Sequence[str]) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()[:32]


class Registry:
    """Layouts by fingerprint; paths that no layout reads do not count."""

    def __init__(self, layouts: Sequence[Layout] = LAYOUTS):
        self.known = {p for layout in layouts for p in layout.paths()}
        self.variants = [(set(v), layout) for layout in layouts for v in layout.variants()]
        self.by_hash = {fingerprint(list(v)): layout for v, layout in reversed(self.variants)}

    def find(self, paths: Sequence[str]) -> tuple[str, Layout | None]:
        own = [p for p in paths if p in self.known]
        key = fingerprint(own)
        if key not in self.by_hash:
            held = [layout for v, layout in self.variants if v <= set(own)]
            return key, held[0] if held else None
        return key, self.by_hash[key]


def schema_paths(kind: DataType, at: str = "") -> list[str]:
    """Paths of all leaves of a Spark type."""
    if isinstance(kind, StructType):
        return [p for f in kind.fields for p in schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, ArrayType):
        return schema_paths(kind.elementType, f"{at}[]")
    return [at]


def value_paths(value, at: str = "") -> set[str]:
    """Paths of all leaves of a JSON value."""
    if isinstance(value, dict):
        return {p for k, v in value.items() for p in value_paths(v, f"{at}.{k}" if at else k)}
    if isinstance(value, list):
        return {p for v in value if v is not None for p in value_paths(v, f"{at}[]")}
    return {at}


# ---------------------------------------------------------------- canonical turns


def _filled(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def _spoken(column: Column, speakers: dict[str, str]) -> Column:
    role = _filled(column)
    if not speakers:
        return role
    names = F.create_map(*[F.lit(x) for pair in speakers.items() for x in pair])
    return F.coalesce(F.element_at(names, role), role)


def canonical(frame: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", registry: Registry | None = None) -> DataFrame:
    """Turns of a frame whose schema has a known layout."""
    paths = schema_paths(frame.schema)
    key, layout = (registry or Registry()).find(paths)
    if layout is None:
        raise ValueError(f"no layout for the fields of this frame (fingerprint {key})")
    conv = F.col(f"`{id_col}`").cast("long").alias("conv_id")
    name = lambda p: F.col(f"`{p}`")
    each = layout.rules[0]
    if isinstance(each, Each):
        if not each.items:
            return frame.select(conv, name(turn_col).cast("long").alias("turn"), _spoken(name(each.role), each.speakers).alias("role"), _filled(name(each.text)).alias("text"))
        rows = frame.select(conv, F.posexplode(name(each.items)).alias("turn", "item")).where("item IS NOT NULL")
        item = F.col("item")
        return rows.select("conv_id", F.col("turn").cast("long"), _spoken(item[each.role], each.speakers).alias("role"), _filled(item[each.text]).alias("text"))
    turns = []
    for at, rule in enumerate(layout.rules):
        there = [name(p) for p in rule.fields if p in paths]
        if there:
            full = F.filter(F.array(*[_filled(c) for c in there]), lambda t: t != "")
            turn = F.struct(F.lit(at).cast("long").alias("turn"), F.lit(rule.role).alias("role"), F.array_join(full, "\n\n").alias("text"))
            turns.append(F.when((F.size(full) > 0) | F.lit(rule.role != "system"), turn))
    rows = frame.select(conv, F.explode(F.array(*turns)).alias("t")).where("t IS NOT NULL")
    return rows.select("conv_id", "t.turn", "t.role", "t.text")


def _said(value) -> str:
    if value is None:
        return ""
    if isinstance(value, str):
        return value.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
    return json.dumps(value, ensure_ascii=False)


def _apply(layout: Layout, record) -> list[dict]:
    turns = []
    for rule in layout.rules:
        if isinstance(rule, Fixed):
            there = [p for p in rule.fields if p in record]
            full = [t for t in (_said(record[p]) for p in there) if t]
            if there and (full or rule.role != "system"):
                turns.append({"role": rule.role, "text": "\n\n".join(full)})
            continue
        for item in record[rule.items] if rule.items else [record]:
            if isinstance(item, dict):
                role = _said(item.get(rule.role))
                turns.append({"role": rule.speakers.get(role, role), "text": _said(item.get(rule.text))})
    return turns


def records(frame: DataFrame, id_col: str = "conv_id", record_col: str = "record", registry: Registry | None = None) -> DataFrame:
    """(conv_id, fingerprint, layout, turns) of JSON texts, each by its own layout."""
    registry = registry or Registry()
    turns = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def run(batches):
        for b in batches:
            out = []
            for text in b.column(1).to_pylist():
                try:
                    value = json.loads(text or "")
                    key, layout = registry.find(sorted(value_paths(value))) if isinstance(value, dict) else (None, None)
                except (ValueError, RecursionError):
                    out.append((None, None, None))
                    continue
                out.append((key, layout and layout.name, layout and _apply(layout, value)))
            keys, names, said = zip(*out, strict=True) if out else ((), (), ())
            yield kernel.batch("conv_id fingerprint layout turns", b.column(0), pa.array(keys, pa.string()), pa.array(names, pa.string()), pa.array(said, turns))

    own = kernel.narrow(frame, conv_id=(id_col, "long"), record=(record_col, "string"))
    return own.mapInArrow(run, "conv_id long, fingerprint string, layout string, turns array<struct<role: string, text: string>>")


def turns_of(found: DataFrame) -> DataFrame:
    """Turns of ``records``; records of unknown layouts have none."""
    rows = found.select("conv_id", F.posexplode("turns").alias("turn", "t"))
    return rows.select("conv_id", F.col("turn").cast("long"), "t.role", "t.text")


# ---------------------------------------------------------------- template

# The marks of the format.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]")
_REST = "|".join(re.escape(c[1:]) for c in CONTROL)
_INSIDE = rf"([<\[])(\\*)({_REST})"
_OUTSIDE = re.compile(rf"([<\[])\\(\\*)({_REST})")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _INSIDE, r"$1$2\\$3")


def unescape(text: str) -> str:
    return _OUTSIDE.sub(r"\1\2\3", text) if "\\" in text else text


def marked(role: Column, text: Column) -> Column:
    """One formatted turn."""
    said = escape(text)
    other = F.concat(F.lit("[ROLE]"), escape(role), F.lit("[/ROLE]"), said, F.lit("</s>"))
    return F.when(role == "user", F.concat(F.lit("<s>[INST] "), said, F.lit(" [/INST]"))).when(role == "assistant", F.concat(F.lit(" "), said, F.lit("</s>"))).otherwise(other)


def parsed(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns of a formatted part."""
    at = 0
    while at < len(text):
        if text.startswith("<s>[INST] ", at):
            end = text.index(" [/INST]", at + 10)
            yield "user", unescape(text[at + 10 : end])
            at = end + 8
        elif text.startswith("[ROLE]", at):
            name = text.index("[/ROLE]", at)
            end = text.index("</s>", name)
            yield unescape(text[at + 6 : name]), unescape(text[name + 7 : end])
            at = end + 4
        else:
            end = text.index("</s>", at)
            yield "assistant", unescape(text[at + 1 : end])
            at = end + 4


_PARTS = "conv_id long, at long, text string, mask array<struct<start: int, length: int>>"


def formatted(turns: DataFrame, part: int = PART) -> DataFrame:
    """(conv_id, at, text, mask): the formatted parts of every conversation, by ``at``.

    ``mask`` holds the ranges of code points that count for the loss.
    """
    mask = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))

    def run(batches):
        first = TaskContext.get().partitionId() << 32
        conv, held, size, ranges, started, made = None, [], 0, [], False, 0
        out: list[tuple] = []

        def close():
            nonlocal held, size, ranges, made
            if held:
                out.append((conv, first + made, "".join(held), ranges))
                made += 1
            held, size, ranges = [], 0, []

        def flush():
            ids, at, texts, masks = zip(*out, strict=True)
            out.clear()
            return kernel.batch("conv_id at text mask", pa.array(ids, pa.int64()), pa.array(at, pa.int64()), pa.array(texts, pa.string()), pa.array(masks, mask))

        for b in batches:
            for c, text, length in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if not started or c != conv or size >= part:
                    close()
                    conv, started = c, True
                held.append(text)
                if length is not None:
                    ranges.append({"start": size + 1, "length": length})
                size += len(text)
            if out:
                yield flush()
        close()
        if out:
            yield flush()

    rows = kernel.narrow(turns, conv_id=("conv_id", "long"), turn=("turn", "long"), role=("role", "string"), text=("text", "string"))
    rows = rows.select("conv_id", "turn", _filled(F.col("role")).alias("role"), _filled(F.col("text")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    key = ["conv_id", "turn", "role", "tie"]
    dealt = rows.repartitionByRange(*key).sortWithinPartitions(*key, "text")
    said = F.when(F.col("role") == "assistant", F.length(escape(F.col("text"))))
    return dealt.select("conv_id", marked(F.col("role"), F.col("text")).alias("text"), said.alias("length")).mapInArrow(run, _PARTS)


_READ = "conv_id long, at long, n_turns long, turns binary, loss binary, loss_chars long, formatted_chars long"
_DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read(parts: DataFrame) -> DataFrame:
    """Counts and digests of every conversation, parsed back from its formatted parts."""

    def parse(batches):
        for b in batches:
            counts, turns, losses, chars, sizes = [], [], [], [], []
            for text, mask in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                said = list(parsed(text))
                under = [unescape(text[m["start"] : m["start"] + m["length"]]) for m in mask]
                counts.append(len(said))
                turns.append("".join(f"{r}\n{t}\n" for r, t in said).encode())
                losses.append("".join(under).encode())
                chars.append(sum(map(len, under)))
                sizes.append(len(text))
            yield kernel.batch("conv_id at n_turns turns loss loss_chars formatted_chars", b.column(0), b.column(1), pa.array(counts, pa.int64()), kernel.blobs(turns), kernel.blobs(losses), pa.array(chars, pa.int64()), pa.array(sizes, pa.int64()))

    def digest(batches):
        conv, state = None, None

        def row():
            return (conv, state[0], state[1].hexdigest(), state[3], state[2].hexdigest(), state[4])

        for b in batches:
            done = []
            for c, _, n, turns, loss, chars, size in zip(*(b.column(i).to_pylist() for i in range(7)), strict=True):
                if state is None or c != conv:
                    if state is not None:
                        done.append(row())
                    conv, state = c, [0, hashlib.sha256(), hashlib.sha256(), 0, 0]
                state[0] += n
                state[1].update(turns)
                state[2].update(loss)
                state[3] += chars
                state[4] += size
            if done:
                yield _digest_rows(done)
        if state is not None:
            yield _digest_rows([row()])

    own = parts.select("conv_id", "at", "text", "mask").mapInArrow(parse, _READ)
    return own.repartition("conv_id").sortWithinPartitions("conv_id", "at").mapInArrow(digest, _DIGESTS)


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    names = "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars"
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return kernel.batch(names, *[pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)])
