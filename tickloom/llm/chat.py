"""Chat formatting: records of many layouts become canonical turns and training text.

A record's schema fingerprint is a hash of its sorted nested field paths (``messages[].role``).  Paths that
no mapping names (ids, names, dates) are passed over: the fingerprint of the others selects a
declarative mapping; nothing is guessed from values.  A record without a mapping comes back with null
turns and the fingerprint of all its paths; ``layouts`` takes further mappings, which ``mapping`` makes.
A record that is null or no JSON has the fingerprint of no path.

The template writes a turn as ``### role: text</turn>`` and a line break.  Backslashes, ``</turn>`` and
``### `` inside roles and texts are escaped so that no control string is left in them; reading back
undoes that exactly.  The loss mask is a list of [start, end) character spans over the assistant texts.

Null and absent texts and roles count as empty; numbers and booleans in their place are
their JSON text; a surrogate that has no partner becomes U+FFFD.  Turns are ordered by turn number (null first), then role and
text, and repeated rows stay.  A conversation is one record and must fit in a row.  A null
conversation id is a conversation of its own.  Very long texts are formatted whole, an empty table gives
an empty one, and other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b, sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END, HEAD, SEP = "</turn>", "### ", ": "
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Layout:
    """Where the turns of a record are: a list of objects, or single fields with fixed roles."""

    turns: str = ""
    role: str = ""
    text: str = ""
    #: (field, role); neighbours of one role are joined by an empty line, empty ones are left out
    fields: tuple[tuple[str, str], ...] = ()
    roles: dict[str, str] = field(default_factory=dict, hash=False)

    def paths(self) -> set[str]:
        return {f"{self.turns}[].{self.role}", f"{self.turns}[].{self.text}"} if self.turns else {f for f, _ in self.fields}

    def read(self, record: dict) -> list[tuple[str, str]]:
        if self.turns:
            each = [(_text(t.get(self.role)), _text(t.get(self.text))) for t in record[self.turns]]
            return [(self.roles.get(role, role), text) for role, text in each]
        out: list[tuple[str, str]] = []
        for name, role in self.fields:
            text = _text(record.get(name))
            if text and out and out[-1][0] == role:
                out[-1] = (role, f"{out[-1][1]}\n\n{text}")
            elif text or name != "input":
                out.append((role, text))
        return out


def _text(value) -> str:
    if value is None:
        return ""
    value = value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    return value.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def paths(value, at: str = "") -> set[str]:
    if isinstance(value, dict):
        return {p for k, v in value.items() for p in paths(v, f"{at}.{k}" if at else k)} or {at}
    if isinstance(value, list):
        return {p for v in value for p in paths(v, f"{at}[]")} or {f"{at}[]"}
    return {at}


def fingerprint(found: set[str]) -> str:
    return blake2b("\n".join(sorted(found)).encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


def mapping(*layouts: Layout) -> dict[str, Layout]:
    """Layouts by the fingerprint that selects them; a list of turns may be empty."""
    out = {}
    for layout in layouts:
        out[fingerprint(layout.paths())] = layout
        if layout.turns:
            out[fingerprint({f"{layout.turns}[]"})] = layout
    return out


LISTS = (
    Layout("messages", "role", "content"), Layout("messages", "role", "text"), Layout("turns", "role", "text"),
    Layout("conversations", "from", "value", roles=ROLES), Layout("dialog", "speaker", "text", roles=ROLES),
)
SINGLES = (
    (("instruction", "user"), ("input", "user"), ("output", "assistant")),
    (("instruction", "user"), ("output", "assistant")),
    (("system", "system"), ("instruction", "user"), ("input", "user"), ("output", "assistant")),
    (("prompt", "user"), ("completion", "assistant")),
    (("prompt", "user"), ("response", "assistant")),
    (("system", "system"), ("prompt", "user"), ("response", "assistant")),
    (("question", "user"), ("answer", "assistant")),
)
LAYOUTS = mapping(*LISTS, *(Layout(fields=f) for f in SINGLES))
_ESCAPES = {"\\\\": "\\", "\\l": "<", "\\h": "#", "\\c": ":"}


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace(END, "\\l" + END[1:]).replace(HEAD, "\\h" + HEAD[1:])


def unescape(text: str) -> str:
    return re.sub(r"\\[\\lhc]", lambda m: _ESCAPES[m[0]], text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[list[int]]]:
    """The formatted text, and the spans of the assistant texts in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = HEAD + escape(role).replace(":", "\\c") + SEP, escape(text)
        if role == "assistant":
            spans.append([at + len(head), at + len(head) + len(body)])
        parts.append(f"{head}{body}{END}\n")
        at += len(parts[-1])
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    turns = []
    for part in formatted.split(END + "\n")[:-1]:
        role, _, text = part[len(HEAD) :].partition(SEP)
        turns.append((unescape(role), unescape(text)))
    return turns


def _format(layouts: dict[str, Layout]):
    named = {p for layout in layouts.values() for p in layout.paths() | ({f"{layout.turns}[]"} if layout.turns else set())}

    def read(raw: str | None) -> tuple[str, list[tuple[str, str]] | None]:
        try:
            record = json.loads(raw) if raw else None
            found = set() if record is None else paths(record)
        except (ValueError, RecursionError):
            record, found = None, set()
        layout = layouts.get(fingerprint(found & named)) if isinstance(record, dict) else None
        return fingerprint(found), layout.read(record) if layout else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, turns, texts, masks = [], [], [], []
            for raw in batch.column("record").to_pylist():
                name, got = read(raw)
                prints.append(name)
                text, mask = render(got) if got is not None else (None, None)
                turns.append([{"role": r, "text": t} for r, t in got] if got is not None else None)
                texts.append(text)
                masks.append(mask)
            kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(prints, pa.string()), pa.array(turns, kind), pa.array(texts, pa.string()), pa.array(masks, pa.list_(pa.list_(pa.int64())))], ["id", "fingerprint", "turns", "formatted", "loss_spans"])

    return run


def format_records(records: DataFrame, id_col: str, record_col: str, layouts: dict[str, Layout] = LAYOUTS) -> DataFrame:
    """``id, fingerprint, turns, formatted, loss_spans`` of JSON records of any layout in ``layouts``."""
    own = records.select(F.col(id_col).alias("id"), F.col(record_col).alias("record"))
    return own.mapInArrow(_format(layouts), f"id {dict(own.dtypes)['id']}, fingerprint string, turns array<struct<role string, text string>>, formatted string, loss_spans array<array<long>>")


def conversation_records(rows: DataFrame) -> DataFrame:
    """Conversations held by turn, as one JSON record each: in one of the layouts of lists of turns, by a hash of the id.

    A role that a layout would read as another keeps its conversation in the first layout, which renames none.
    """
    each = F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    told = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(each)).alias("t"))
    renamed = F.exists("t", lambda t: t["role"].isin(*ROLES))
    which = F.when(renamed, 0).otherwise(F.pmod(F.xxhash64("conv_id"), F.lit(len(LISTS))))
    record = None
    for k, layout in enumerate(LISTS):
        back = {role: name for name, role in reversed(layout.roles.items())}
        name = lambda role: F.coalesce(F.create_map(*[F.lit(x) for pair in back.items() for x in pair])[role], role) if back else role  # noqa: B023, E731
        turns = F.transform("t", lambda t: F.struct(name(t["role"]).alias(layout.role), t["text"].alias(layout.text)))  # noqa: B023
        own = F.to_json(F.struct(turns.alias(layout.turns)))
        record = F.when(which == k, own) if record is None else record.when(which == k, own)
    return told.select("conv_id", record.alias("record"))


def digest(formatted: DataFrame) -> DataFrame:
    """What can be read back from formatted texts and their loss spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("loss_spans").to_pylist()):
                turns = parse(text or "")
                under = "".join(unescape((text or "")[a:b]) for a, b in spans or [])
                whole = "".join(f"{r}\n{t}\n" for r, t in turns)
                rows.append((len(turns), sha256(whole.encode()).hexdigest(), len(under), sha256(under.encode()).hexdigest(), len(text or "")))
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(list(c), k) for c, k in zip(zip(*rows) if rows else [()] * 5, (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())))], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    own = formatted.select("id", "formatted", "loss_spans")
    return own.mapInArrow(run, f"conv_id {dict(own.dtypes)['id']}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def chat_digest(rows: DataFrame) -> DataFrame:
    return digest(format_records(conversation_records(rows), "conv_id", "record"))
