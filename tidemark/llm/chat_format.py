"""Format conversations as training text, assembled column by column into preallocated bytes.

Template: system ``<<SYS>>\n text \n<</SYS>>\n``, user ``[INST] text [/INST]``, assistant
`` <s> text </s>``, any other role ``<<ROLE>>role\n<</ROLE>>\n text \n<</TURN>>\n``. Control strings inside
texts and roles get one more backslash before them, so that one without a backslash is the template's own;
a blank or line end always stands between a text and the control string behind it. Reading back removes
one backslash before each control string.

Conversations are hash-partitioned by id and sorted by turn, then role and text. A task streams batches of
turns: segment lengths, their running sums and scatter indices are numpy arrays, and headers, contents
and footers are copied into one buffer of the batch. A row of the result is a run of turns of one conversation
in one batch, so a conversation of any length passes in bounded memory; ``piece`` numbers its runs.

Defined results: null text is empty, null role an empty one, null id a conversation of its own; repeated
rows stay; an empty table gives an empty result; other columns are not used.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Header and footer by role; the empty key serves all other roles.
TEMPLATE = {
    "system": ("<<SYS>>\n", "\n<</SYS>>\n"),
    "user": ("[INST] ", " [/INST]"),
    "assistant": (" <s> ", " </s>"),
    "": ("<<ROLE>>", "\n<</TURN>>\n"),
}
AFTER_ROLE = "\n<</ROLE>>\n"
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<ROLE>>", "<</ROLE>>", "<</TURN>>")
BACKSLASH = 0x5C


def buffer_of(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all strings in a row, and their offsets; null counts as empty."""
    strings = strings.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(strings.buffers()[1], np.int64, len(strings) + 1, strings.offset * 8)
    data = strings.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def control_starts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where control strings start, none across two strings."""
    starts = []
    for control in CONTROL:
        code = np.frombuffer(control.encode(), np.uint8)
        if len(raw) < len(code):
            continue
        at = np.flatnonzero(raw[: len(raw) - len(code) + 1] == code[0])
        for k in range(1, len(code)):
            at = at[raw[at + k] == code[k]]
        row_end = offsets[np.searchsorted(offsets, at, "right")]
        starts.append(at[at + len(code) <= row_end])
    return np.sort(np.concatenate(starts)) if starts else np.zeros(0, np.int64)


def escaped(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = control_starts(raw, offsets)
    if not len(starts):
        return raw, offsets
    return np.insert(raw, starts, BACKSLASH), offsets + np.searchsorted(starts, offsets, "left")


def unescaped(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    extra = control_starts(raw, offsets) - 1
    return np.delete(raw, extra), offsets - np.searchsorted(extra, offsets, "left")


def scatter(out: np.ndarray, to: np.ndarray, raw: np.ndarray, offsets: np.ndarray, rows: np.ndarray | None = None) -> None:
    """Copy string k (or string rows[k]) to out[to[k]:]."""
    first, length = (offsets[:-1], np.diff(offsets)) if rows is None else (offsets[:-1][rows], np.diff(offsets)[rows])
    within = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    out[np.repeat(to, length) + within] = raw[np.repeat(first, length) + within]


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Formatted bytes of a batch of turns; each turn's offset, and where its text begins and ends there."""
    names = np.array(roles.cast(pa.string()).fill_null("").to_pylist(), object)
    kinds = list(TEMPLATE)
    kind = np.array([kinds.index(r) if r in TEMPLATE and r else kinds.index("") for r in names], np.int64)
    heads = buffer_of(pa.array([h for h, _ in TEMPLATE.values()]))
    feet = buffer_of(pa.array([f for _, f in TEMPLATE.values()]))
    other = kind == kinds.index("")
    role_raw, role_at = escaped(*buffer_of(pa.array(["" if not o else r for r, o in zip(names, other)], pa.string())))
    after = buffer_of(pa.array(["", AFTER_ROLE]))
    text_raw, text_at = escaped(*buffer_of(texts))
    lengths = np.stack([np.diff(heads[1])[kind], np.diff(role_at), np.diff(after[1])[other.astype(int)], np.diff(text_at), np.diff(feet[1])[kind]], 1)
    ends = np.cumsum(lengths.ravel()).reshape(lengths.shape) if lengths.size else lengths
    begins = ends - lengths
    out = np.empty(int(lengths.sum()), np.uint8)
    scatter(out, begins[:, 0], *heads, kind)
    scatter(out, begins[:, 1], role_raw, role_at)
    scatter(out, begins[:, 2], *after, other.astype(int))
    scatter(out, begins[:, 3], text_raw, text_at)
    scatter(out, begins[:, 4], *feet, kind)
    return out, np.append(begins[:, 0], len(out)), begins[:, 3], ends[:, 3]


def format_chats(rows: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text", loss_role: str = "assistant") -> DataFrame:
    """Rows of (id, piece, formatted, n_turns, loss): formatted bytes, and the byte ranges in them under the loss mask."""
    turns = rows.select(F.col(id_column), F.col(turn_column).alias("_turn"), F.col(role_column).cast("string").alias("_role"), F.col(text_column).cast("string").alias("_text"))
    turns = turns.repartition(id_column).sortWithinPartitions(id_column, "_turn", "_role", "_text")
    kind = dict(turns.dtypes)[id_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, piece = object(), 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            out, at, begin, end = assemble(batch.column(2), batch.column(3))
            loss = np.array([r == loss_role for r in batch.column(2).to_pylist()])
            ids = batch.column(0).to_pylist()
            first = np.array([0] + [k for k in range(1, n) if ids[k] != ids[k - 1]] + [n])
            pieces = []
            for k in first[:-1]:
                piece = piece + 1 if ids[k] == last else 0
                last = ids[k]
                pieces.append(piece)
            start = np.repeat(at[first[:-1]], np.diff(first))
            spans = pa.StructArray.from_arrays([pa.array((begin - start)[loss]), pa.array((end - begin)[loss])], ["start", "length"])
            span_at = np.concatenate([[0], np.cumsum(loss)])[first]
            formatted = pa.Array.from_buffers(pa.large_binary(), len(first) - 1, [None, pa.py_buffer(at[first].astype(np.int64).tobytes()), pa.py_buffer(out)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(first[:-1])), pa.array(pieces, pa.int64()), formatted.cast(pa.binary()), pa.array(np.diff(first)), pa.ListArray.from_arrays(pa.array(span_at, pa.int32()), spans)],
                [id_column, "piece", "formatted", "n_turns", "loss"],
            )

    return turns.mapInArrow(run, f"`{id_column}` {kind}, piece long, formatted binary, n_turns long, loss array<struct<start:long,length:long>>")


def parse(formatted: bytes) -> list[tuple[str, str]]:
    """The roles and texts of a formatted run of turns, from its bytes alone."""
    raw = np.frombuffer(formatted, np.uint8)
    starts = control_starts(raw, np.array([0, len(raw)]))
    own = starts[(starts == 0) | (raw[np.maximum(starts - 1, 0)] != BACKSLASH)]
    turns, k, at = [], 0, 0

    def plain(a: int, b: int) -> str:
        return unescaped(raw[a:b], np.array([0, b - a]))[0].tobytes().decode()

    while k < len(own):
        for role, (head, foot) in TEMPLATE.items():
            if formatted.startswith(head.encode(), at):
                break
        else:
            raise ValueError("no header where a turn should start")
        begin = at + len(head)
        if not role:
            stop = int(own[k + 1]) - 1
            role, begin, k = plain(begin, stop), stop + len(AFTER_ROLE), k + 1
        end = int(own[k + 1]) - (len(foot) - len(foot.lstrip()))
        turns.append((role, plain(begin, end)))
        at, k = end + len(foot), k + 2
    return turns


def digest_chats(chats: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """Per conversation, read back from ``formatted`` and ``loss``: counts and digests of turns and of the masked text."""
    kind = dict(chats.dtypes)[id_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [id_column, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        done: list[tuple] = []
        now = None

        def close(c):
            return (c[0], c[1], c[2].hexdigest(), c[3], c[4].hexdigest(), c[5])

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done)) if done else [[]] * 6
            kinds = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)
            done.clear()
            return batch

        id_type = None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for conv, piece, raw, spans in zip(*(batch.column(c).to_pylist() for c in (id_column, "piece", "formatted", "loss"))):
                if piece == 0:
                    if now is not None:
                        done.append(close(now))
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse(raw):
                    now[1] += 1
                    now[2].update(f"{role}\n{text}\n".encode())
                for span in spans:
                    part = np.frombuffer(raw, np.uint8)[span["start"] : span["start"] + span["length"]]
                    text = unescaped(part, np.array([0, len(part)]))[0].tobytes()
                    now[3] += len(text.decode())
                    now[4].update(text)
                now[5] += len(raw.decode())
            yield flush()
        if now is not None:
            done.append(close(now))
            yield flush()

    return chats.mapInArrow(run, f"`{id_column}` {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
