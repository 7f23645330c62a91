"""Chat formatting: conversations assembled column by column into one preallocated buffer a batch."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagemart.llm.shipping import session_of
from stagemart.llm.words import raw

#: Bytes scattered at a time; the scatter indices take eight bytes for each of them.
SCATTER_BYTES = 1 << 21
#: A conversation longer than this is put out in parts.
PART_BYTES = 16 << 20


@dataclass(frozen=True)
class Template:
    """Marks around a turn: ``opening``, role, line feed, text, ``closing``.

    ``controls`` are the strings that a model reads as commands. Inside roles and texts they get a
    backslash after their first character, and those that already have backslashes there get one
    more, so that taking one away gives the text back. Line feeds and backslashes in roles are
    written as two characters.
    """

    opening: str = "<|im_start|>"
    closing: str = "<|im_end|>\n"
    controls: tuple[str, ...] = ("<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

    @property
    def escaping(self) -> tuple[str, str]:
        """Pattern of first character, backslashes and rest, and its replacement."""
        firsts = "".join(re.escape(first) for first in dict.fromkeys(control[0] for control in self.controls))
        rests = "|".join(re.escape(control[1:]).replace("\\<", "<").replace("\\>", ">") for control in self.controls)
        return rf"([{firsts}])(\\*)({rests})", r"\1\\\2\3"

    def escape(self, text: pa.Array) -> pa.Array:
        pattern, replacement = self.escaping
        return pc.replace_substring_regex(text, pattern, replacement)

    def unescape(self, text: str) -> str:
        pattern, _ = self.escaping
        return re.sub(pattern.replace(r"(\\*)", r"\\(\\*)"), lambda found: found[1] + found[2] + found[3], text) if "\\" in text else text

    def role_in(self, role: str | None) -> str:
        return (role or "").replace("\\", "\\\\").replace("\n", "\\n")

    def role_out(self, role: str) -> str:
        return re.sub(r"\\(.)", lambda found: "\n" if found[1] == "n" else found[1], role)


def _scatter(out: np.ndarray, to: np.ndarray, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> None:
    """Copy the pieces ``data[start : start + length]`` to ``out[to:]``, in blocks of index arrays."""
    total = np.concatenate([[0], np.cumsum(length)])
    first = 0
    while first < len(length):
        last = max(first + 1, int(np.searchsorted(total, total[first] + SCATTER_BYTES, "right")) - 1)
        if last == first + 1:
            out[to[first] : to[first] + length[first]] = data[start[first] : start[first] + length[first]]
        else:
            sizes = length[first:last]
            step = np.arange(total[last] - total[first]) - np.repeat(total[first:last] - total[first], sizes)
            out[np.repeat(to[first:last], sizes) + step] = data[np.repeat(start[first:last], sizes) + step]
        first = last


def assemble(roles: pa.Array, texts: pa.Array, first_turns: np.ndarray, template: Template, trained: str) -> tuple[pa.Array, pa.Array]:
    """One formatted string and the spans under the loss mask for each conversation of the batch.

    ``first_turns`` are the rows at which conversations start. Header, text and closing of every
    turn get their places from one running sum of lengths, and each kind is scattered into the one
    buffer that becomes the data of the Arrow column. Spans are in code points.
    """
    count = len(roles)
    coded = roles.fill_null("").dictionary_encode()
    names = coded.dictionary.to_pylist()
    headers = template.escape(pa.array([template.role_in(name) for name in names], pa.string())).to_pylist()
    headers = [f"{template.opening}{name}\n" for name in headers]
    header_data = np.frombuffer("".join(headers).encode(), np.uint8)
    header_length = np.array([len(header.encode()) for header in headers], np.int64)
    header_points = np.array([len(header) for header in headers], np.int64)
    header_start = np.cumsum(header_length) - header_length
    closing = np.frombuffer(template.closing.encode(), np.uint8)
    index = np.asarray(coded.indices, np.int64)
    escaped = template.escape(texts.fill_null(""))
    data, offsets = raw(escaped)

    lengths = np.empty((count, 3), np.int64)
    lengths[:, 0], lengths[:, 1], lengths[:, 2] = header_length[index], np.diff(offsets), len(closing)
    ends = np.cumsum(lengths.ravel()).reshape(count, 3)
    starts = ends - lengths
    buffer = pa.allocate_buffer(int(ends[-1, 2]))
    out = np.frombuffer(buffer, np.uint8)
    _scatter(out, starts[:, 0], header_data, header_start[index], lengths[:, 0])
    _scatter(out, starts[:, 1], data, offsets[:-1], lengths[:, 1])
    _scatter(out, starts[:, 2], closing, np.zeros(count, np.int64), lengths[:, 2])
    borders = np.concatenate([starts[first_turns, 0], ends[-1:, 2]])
    formatted = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first_turns), [None, pa.py_buffer(borders), buffer])

    text_points = np.asarray(pc.utf8_length(escaped), np.int64)
    points = np.cumsum(header_points[index] + text_points + len(template.closing))
    before = points - text_points - len(template.closing)
    conversation = np.repeat(np.arange(len(first_turns)), np.diff(np.append(first_turns, count)))
    base = (points - header_points[index] - text_points - len(template.closing))[first_turns]
    learned = np.flatnonzero(np.array([name == trained for name in names])[index])
    spans = pa.StructArray.from_arrays(
        [pa.array(before[learned] - base[conversation[learned]]), pa.array(text_points[learned])], ["start", "length"]
    )
    list_offsets = np.searchsorted(conversation[learned], np.arange(len(first_turns) + 1)).astype(np.int32)
    return formatted.cast(pa.large_string()), pa.ListArray.from_arrays(pa.array(list_offsets), spans)


FORMATTED = "conv_id long, part int, n_turns long, formatted string, loss array<struct<start:long,length:long>>"


def format_conversations(
    rows: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text",
    template: Template = Template(), trained: str = "assistant", part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Conversations as strings with their loss spans: (conv_id, part, n_turns, formatted, loss).

    Rows are dealt by conversation and sorted by turn, equal turns by role and text; repeated rows
    are turns of their own. Batches stream through, so memory holds a batch and not a conversation;
    one longer than ``part_bytes`` comes in parts, in order, whose strings follow on from each other
    and whose spans count from the part's start. A null text or role is empty, a null id is an id,
    null turns come first. Empty tables give no row.
    """
    session_of(rows)
    dealt = (
        rows.select(
            F.col(id_column).cast("long").alias("conv_id"), F.col(turn_column).alias("turn"), F.col(role_column).cast("string").alias("role"),
            F.col(text_column).cast("string").alias("text"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
    )

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        parts: dict[int | None, int] = {}

        def put(table: pa.Table) -> pa.RecordBatch:
            ids = table["conv_id"].combine_chunks()
            number = np.asarray(ids.fill_null(0))
            missing = np.asarray(ids.is_null())
            new = np.ones(len(ids), bool)
            new[1:] = (number[1:] != number[:-1]) | (missing[1:] != missing[:-1])
            first = np.flatnonzero(new)
            text, loss = assemble(table["role"].combine_chunks(), table["text"].combine_chunks(), first, template, trained)
            own = ids.take(pa.array(first))
            sizes = np.diff(np.append(first, len(ids)))
            leading, last = own[0].as_py(), own[-1].as_py()
            part = np.zeros(len(first), np.int32)
            part[0] = parts.pop(leading, 0)
            parts.clear()
            parts[last] = int(part[-1]) + 1
            return pa.RecordBatch.from_arrays(
                [own, pa.array(part), pa.array(sizes), text.cast(pa.string()), loss], ["conv_id", "part", "n_turns", "formatted", "loss"]
            )

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            held = None
            if not len(table):
                continue
            ids = table["conv_id"].combine_chunks()
            same = pc.is_null(ids) if not ids[-1].is_valid else pc.fill_null(pc.equal(ids, ids[-1]), False)
            start = len(table) - pc.sum(same).as_py()  # the last conversation may go on in the next batch
            if start:
                yield put(table.slice(0, start))
            held = table.slice(start)
            if held.nbytes > part_bytes:
                yield put(held)
                held = None
        if held is not None and len(held):
            yield put(held)

    return dealt.mapInArrow(formatted, FORMATTED)


def parse(formatted: str, template: Template) -> list[tuple[str, str]]:
    """Role and text of each turn, read back from a formatted string."""
    opening, closing = re.escape(template.opening), re.escape(template.closing)
    return [
        (template.role_out(template.unescape(found[1])), template.unescape(found[2]))
        for found in re.finditer(rf"{opening}(.*?)\n(.*?){closing}", formatted, re.DOTALL)
    ]


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """Counts and digests of conversations, from their formatted strings and spans alone.

    ``turns_sha256`` is over role, line feed, text, line feed of each turn; ``loss_sha256`` over the
    unescaped texts under the spans. Takes the frame of :func:`format_conversations` as it is, whose
    parts of a conversation follow each other within a partition, and keeps running digests only.
    """

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None

        def ended() -> tuple:
            return state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]

        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if row["part"] == 0:
                    if state is not None:
                        found.append(ended())
                    state = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                text = row["formatted"]
                for role, said in parse(text, template):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode())
                for span in row["loss"]:
                    said = template.unescape(text[span["start"] : span["start"] + span["length"]])
                    state[3] += len(said)
                    state[4].update(said.encode())
                state[5] += len(text)
            if found:
                yield _digest_rows(found)
        if state is not None:
            yield _digest_rows([ended()])

    return formatted.mapInArrow(digested, DIGESTS)


def _digest_rows(found: list[tuple]) -> pa.RecordBatch:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*found), kinds)], names)


def escaped(text: Column, template: Template = Template()) -> Column:
    """The same escape as a Spark expression."""
    pattern, _ = template.escaping
    return F.regexp_replace(text, pattern, r"$1\\$2$3")
