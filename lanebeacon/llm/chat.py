"""Conversations as training text, by compiled templates.

The rows of a conversation are sorted within its task and rendered as they come: a template that is one
loop over the turns (``Template.by_turns``) needs no more than the turn at hand. Conversations that hold a large share of
all rows are numbered over ranges and cut into runs of turns first, which are rendered apart. Long
conversations come as several parts of whole turns, so that no task holds more than a part.

Control strings inside texts are escaped with a backslash behind their first character, and so is the beginning
of one at the end of a text; backslashes are doubled. What is left has no control string, and
``unescape`` restores the text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanebeacon.llm.common import shuffle_partitions, small_batches, table
from lanebeacon.llm.numbering import numbered
from lanebeacon.llm.templates import FILTERS, Template, TemplateError, Writer, turn_of

# Bytes of a conversation from which it is cut into runs, at least, and how many conversations are cut at most: a
# conversation with less than that share of all bytes is left to one task, which renders it part by part.
PART_BYTES = 4 << 20
MOST_CUT = 100_000

# Fixed value: both texts of the conversation that the query adds.
ADDED_TEXT = "</s>[INST] ok [/INST]"


class Escaping:
    """Takes control strings out of texts, reversibly."""

    def __init__(self, controls: Sequence[str]):
        if any(len(c) < 2 or "\\" in c for c in controls):
            raise TemplateError("control strings have two characters or more and no backslash")
        starts = {c[:n] for c in controls for n in range(1, len(c))}
        whole, ends = ("|".join(map(re.escape, sorted(those, key=len, reverse=True))) for those in (controls, starts))
        self._found = re.compile(rf"\\|(?=(?:{whole})|(?:{ends})\Z).", re.DOTALL)
        self._first = re.compile("[" + "".join({re.escape(c[0]) for c in controls}) + r"\\]")
        self.controls = re.compile(whole)

    def escape(self, text: str) -> str:
        if not self._first.search(text):
            return text
        return self._found.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


@dataclass(frozen=True)
class ChatFormat:
    """A template over ``turns`` with ``role`` and ``text``, its control strings, and how it is read back.

    ``reader`` matches one turn; its group ``text`` is the text and ``role`` the role, or the text is in a group
    named by the role. The template has the filter ``escape``.
    """

    source: str
    controls: tuple[str, ...]
    reader: str
    name: str = field(default="chat")

    @cached_property
    def escaping(self) -> Escaping:
        return Escaping(self.controls)

    @cached_property
    def template(self) -> Template:
        return Template(self.source, FILTERS | {"escape": lambda a: self.escaping.escape(a if isinstance(a, str) else "")})

    @cached_property
    def _reader(self) -> re.Pattern:
        return re.compile(self.reader, re.DOTALL)

    def __getstate__(self):
        # Closures are compiled where they run.
        return {name: getattr(self, name) for name in ("source", "controls", "reader", "name")}

    def turns(self, formatted: str) -> Iterator[tuple[str, str]]:
        """Roles and texts of the turns of a formatted text, restored."""
        place = 0
        for match in self._reader.finditer(formatted):
            if match.start() != place:
                break
            place = match.end()
            found = {name: value for name, value in match.groupdict().items() if value is not None}
            if "role" in found:
                yield unescape(found["role"]), unescape(found["text"])
            else:
                ((role, text),) = found.items()
                yield role, unescape(text)
        if place != len(formatted):
            raise ValueError(f"no turn at character {place}")


# Roles other than the three common ones are written out.
INSTRUCTIONS = ChatFormat(
    source=(
        "{% for turn in turns %}"
        "{% if turn.role == 'user' %}[INST] {{ turn.text | escape }} [/INST]"
        "{% elif turn.role == 'assistant' %}<s>{% generation %}{{ turn.text | escape }}{% endgeneration %}</s>"
        "{% elif turn.role == 'system' %}<<SYS>> {{ turn.text | escape }} <</SYS>>"
        "{% else %}[ROLE] {{ turn.role | escape }} [/ROLE] {{ turn.text | escape }} [END]"
        "{% endif %}{% endfor %}"
    ),
    controls=("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[END]"),
    reader=(
        r"\[INST\] (?P<user>.*?) \[/INST\]|<s>(?P<assistant>.*?)</s>|<<SYS>> (?P<system>.*?) <</SYS>>"
        r"|\[ROLE\] (?P<role>.*?) \[/ROLE\] (?P<text>.*?) \[END\]"
    ),
)

# Columns besides the id, for Spark and for Arrow.
_PART = "part bigint, whole boolean, n_turns bigint, formatted string, loss array<struct<start:int,end:int>>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_PART_FIELDS = {"part": pa.int64(), "whole": pa.bool_(), "n_turns": pa.int64(), "formatted": pa.string(), "loss": _SPANS}


def _schema(batch: pa.RecordBatch, fields: dict[str, pa.DataType]) -> pa.Schema:
    return pa.schema([("conv_id", batch.schema.field(0).type), *fields.items()])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


class _Renderer:
    """Renders sorted rows ``conv_id, run, idx, n, role, text`` into parts.

    ``idx`` and ``n``, a turn's number and the number of turns, are NULL where a run is a whole conversation.
    """

    def __init__(self, chat: ChatFormat, part_bytes: int):
        self._template, self._part_bytes = chat.template, part_bytes
        self._turns = chat.template.by_turns("turns")
        self._out: Writer | None = None
        self._gathered: list[dict] = []
        self._first = self._next = 0
        self.parts: list[tuple] = []
        self.size = 0

    def take(self, row: tuple, ends_run: bool) -> None:
        """One turn, of which it is known whether it ends its run."""
        key, _, idx, n, role, text = row
        turn = {"role": role, "text": text}
        if self._turns:
            self._by_itself(key, turn, idx, n, ends_run)
            return
        self._gathered.append(turn)
        if ends_run:
            self._out, self._first, self._next = self._template.render(turns=self._gathered), 0, len(self._gathered)
            self._done(key, True)
            self._gathered = []

    def _by_itself(self, key, turn: dict, idx: int | None, n: int | None, ends_run: bool) -> None:
        if self._out is None:
            self._out, self._first = Writer(), idx or 0
            self._next = self._first
            if self._first == 0:
                self._turns.head({}, self._out)
        last = ends_run and (n is None or self._next == n - 1)
        self._turns.turn({self._turns.name: turn, "loop": turn_of(self._next) | {"last": last}}, self._out)
        self._next += 1
        if last:
            self._turns.tail({}, self._out)
        if ends_run:
            self._done(key, last)
        elif self._out.place >= self._part_bytes:
            self._done(key, False)
            self._out, self._first = Writer(), self._next

    def _done(self, key, last: bool) -> None:
        text = self._out.text()
        spans = [{"start": a, "end": b} for a, b in self._out.spans]
        self.parts.append((key, self._first, self._first == 0 and last, self._next - self._first, text, spans))
        self.size += len(text)
        self._out = None


def _rendered(chat: ChatFormat, part_bytes: int):
    def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        renderer = _Renderer(chat, part_bytes)
        waiting, schema = None, None
        for batch in batches:
            schema = _schema(batch, _PART_FIELDS)
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if waiting is not None:
                    renderer.take(waiting, row[:2] != waiting[:2])
                waiting = row
                if renderer.size > part_bytes:
                    yield _batch(renderer.parts, schema)
                    renderer.parts, renderer.size = [], 0
        if waiting is not None:
            renderer.take(waiting, True)
            yield _batch(renderer.parts, schema)

    return conversations


def format_conversations(
    rows: DataFrame,
    chat: ChatFormat = INSTRUCTIONS,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``conv_id, part, whole, n_turns, formatted, loss``: the text of every conversation and what of it is trained on.

    ``loss`` has the stretches of ``formatted`` under the loss mask, in code points, end exclusive. A conversation is one row,
    but one of more than about ``part_bytes`` has several of whole turns, in order of ``part`` (the number of its first turn),
    and its text is theirs in a row; ``whole`` says that there is one. If the template is not one loop over the turns,
    conversations are never cut and each is rendered in one task.

    Turns are ordered by ``turn``, NULL first, ties by role and then by a hash of the text; repeated rows are turns of their
    own. NULL roles and texts are empty. All rows without an id are one conversation, without rows there
    is none. Other columns are not looked at.
    """
    spark = rows.sparkSession
    small_batches(spark)
    given = rows.select(
        rows[conv_col].alias("conv_id"),
        rows[turn_col].alias("turn"),
        F.coalesce(rows[role_col], F.lit("")).alias("role"),
        F.coalesce(rows[text_col], F.lit("")).alias("text"),
    )
    order = ["turn", "role", F.xxhash64("text")]
    n = shuffle_partitions(spark)
    large = _large(given, part_bytes) if chat.template.by_turns("turns") else None
    plain = given if large is None else given.join(F.broadcast(large), given["conv_id"].eqNullSafe(large["large_id"]), "left_anti")
    none = F.lit(None).cast("bigint")
    ready = plain.repartition(n, "conv_id").sortWithinPartitions("conv_id", *order)
    ready = ready.select("conv_id", F.lit(0).cast("bigint").alias("run"), none.alias("idx"), none.alias("n"), "role", "text")
    schema = f"conv_id {given.schema['conv_id'].dataType.simpleString()}, {_PART}"
    formatted = ready.mapInArrow(_rendered(chat, part_bytes), schema)
    if large is None:
        return formatted
    keyed = given.join(F.broadcast(large), given["conv_id"].eqNullSafe(large["large_id"])).select(
        F.coalesce(F.concat(F.lit("+"), F.col("conv_id").cast("string")), F.lit("")).alias("conversation"),
        "conv_id",
        "turn",
        "role",
        F.xxhash64("text").alias("text_hash"),
        "text",
        "bytes",
    )
    runs = numbered(keyed, "conversation", ["turn", "role", "text_hash"])
    pieces = F.call_function("div", F.col("bytes") + (part_bytes - 1), F.lit(part_bytes).cast("bigint"))
    run = F.call_function("div", F.col("idx") * pieces, F.col("n"))
    cut = runs.withColumn("run", run).repartition(n, "conv_id", "run").sortWithinPartitions("conv_id", "run", "idx")
    return formatted.unionByName(cut.select("conv_id", "run", "idx", "n", "role", "text").mapInArrow(_rendered(chat, part_bytes), schema))


def _large(given: DataFrame, part_bytes: int) -> DataFrame | None:
    """``large_id, bytes`` of conversations to cut, ``MOST_CUT`` at most by the choice of their size; None without any."""
    size = (F.octet_length("role") + F.octet_length("text") + 16).cast("bigint")
    sizes = given.groupBy(F.col("conv_id").alias("large_id")).agg(F.sum(size).alias("bytes"))
    total, most = sizes.agg(F.sum("bytes"), F.max("bytes")).first()
    least = max(part_bytes, -(-(total or 0) // MOST_CUT))
    return sizes.where(F.col("bytes") > least) if (most or 0) > least else None


_READ = "part bigint, whole boolean, n_turns bigint, turns binary, loss binary, loss_chars bigint, formatted_chars bigint"
_READ_FIELDS = {
    "part": pa.int64(),
    "whole": pa.bool_(),
    "n_turns": pa.int64(),
    "turns": pa.binary(),
    "loss": pa.binary(),
    "loss_chars": pa.int64(),
    "formatted_chars": pa.int64(),
}
_DIGESTS = "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
_DIGEST_FIELDS = {
    "n_turns": pa.int64(),
    "turns_sha256": pa.string(),
    "loss_chars": pa.int64(),
    "loss_sha256": pa.string(),
    "formatted_chars": pa.int64(),
}


def _read_back(chat: ChatFormat):
    """What is read from each part: the turns and the text under the mask, or their digests if the part is whole."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for key, part, whole, formatted, loss in zip(*(column.to_pylist() for column in batch.columns)):
                spoken = list(chat.turns(formatted))
                turns = "".join(f"{role}\n{text}\n" for role, text in spoken).encode()
                masked = "".join(unescape(formatted[span["start"] : span["end"]]) for span in loss)
                trained = masked.encode()
                if whole:
                    turns, trained = hashlib.sha256(turns).digest(), hashlib.sha256(trained).digest()
                found.append((key, part, whole, len(spoken), turns, trained, len(masked), len(formatted)))
            yield _batch(found, _schema(batch, _READ_FIELDS))

    return read


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations from parts in order. Of a cut conversation only the states of two digests are kept."""
    schema, key, running, kept = None, None, None, []

    def done() -> tuple:
        n, turns, chars, loss, formatted = running
        return key, n, turns.hexdigest(), chars, loss.hexdigest(), formatted

    for batch in batches:
        schema = _schema(batch, _DIGEST_FIELDS)
        for own, _, whole, n, turns, loss, chars, formatted in zip(*(column.to_pylist() for column in batch.columns)):
            if running and (whole or own != key):
                kept.append(done())
                running = None
            if whole:
                kept.append((own, n, turns.hex(), chars, loss.hex(), formatted))
                continue
            if not running:
                key, running = own, (0, hashlib.sha256(), 0, hashlib.sha256(), 0)
            running[1].update(turns)
            running[3].update(loss)
            running = (running[0] + n, running[1], running[2] + chars, running[3], running[4] + formatted)
        if kept:
            yield _batch(kept, schema)
            kept = []
    if running:
        yield _batch([done()], schema)


def read_back(formatted: DataFrame, chat: ChatFormat = INSTRUCTIONS) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``, all read from the formatted texts.

    ``turns_sha256`` is over role, line feed, text, line feed of every turn. A digest is a chain, so the parts of a cut
    conversation pass one task in order, which keeps nothing of them but the states of the digests.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()
    columns = formatted.select("conv_id", "part", "whole", "formatted", "loss")
    parts = columns.mapInArrow(_read_back(chat), f"conv_id {kind}, {_READ}")
    in_order = parts.repartition(shuffle_partitions(formatted.sparkSession), "conv_id").sortWithinPartitions("conv_id", "part")
    return in_order.mapInArrow(_digested, f"conv_id {kind}, {_DIGESTS}")


def op11_chat(spark, sf_dir: str) -> DataFrame:
    """All conversations and one more, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant"))
    added = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(ADDED_TEXT).alias("text"))
    return read_back(format_conversations(rows.unionByName(added)))


def _escapes_sql(column: str) -> str:
    """How many characters escaping adds: one for each backslash, control string and beginning of one at the end."""
    controls = [c.replace("'", "''") for c in INSTRUCTIONS.controls]
    starts = sorted({c[:n] for c in controls for n in range(1, len(c))})
    inside = [f"(length({column}) - length(replace({column}, '{c}', ''))) // {len(c)}" for c in ["\\", *controls]]
    return " + ".join([*inside, *(f"ends_with({column}, '{s}')::int" for s in starts)])


OP11_SQL = f"""
with turns as (
  select conv_id, turn, coalesce("role", '') as "role", coalesce("text", '') as "text" from conversations
  union all select -1, 0, 'user', '{ADDED_TEXT}'
  union all select -1, 1, 'assistant', '{ADDED_TEXT}'),
sized as (
  select *, "role" = 'assistant' as trained, length("text") + {_escapes_sql('"text"')} as chars,
         length("role") + {_escapes_sql('"role"')} as role_chars
  from turns)
select conv_id, count(*) as n_turns,
       sha256(string_agg("role" || chr(10) || "text" || chr(10), '' order by turn)) as turns_sha256,
       cast(coalesce(sum(length("text")) filter (where trained), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg("text", '' order by turn) filter (where trained), '')) as loss_sha256,
       cast(sum(chars + case "role" when 'user' then 15 when 'assistant' then 7 when 'system' then 17
                        else role_chars + 22 end) as bigint) as formatted_chars
from sized group by conv_id"""
