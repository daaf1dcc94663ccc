"""What Parquet files say about their column chunks without decoding the pages of values: footers and dictionary pages."""

from __future__ import annotations

import datetime as dt
import json
import struct
from functools import cached_property
from urllib.parse import unquote, urlparse

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq

#: Text extrema from this length on may have been cut by the writer and are not taken from footers.
EXACT_TEXT = 32
#: Bytes read for the header of a dictionary page.
HEADER = 256
# Units of a timestamp a day; page type and encodings of the file format.
DAY_UNITS = {"milliseconds": 86_400_000, "microseconds": 86_400_000_000, "nanoseconds": 86_400_000_000_000}
ARROW_UNITS = {"milliseconds": "ms", "microseconds": "us", "nanoseconds": "ns"}
DICTIONARY_PAGE, BY_DICTIONARY = 2, {2, 8}


def _varint(data: bytes, at: int) -> tuple[int, int]:
    out = shift = 0
    while True:
        b = data[at]
        at += 1
        out |= (b & 0x7F) << shift
        if b < 0x80:
            return out, at
        shift += 7


def _value(data: bytes, at: int, kind: int) -> tuple[object, int]:
    if kind in (1, 2):
        return data[at] == 1, at + 1
    if kind == 3:
        return data[at], at + 1
    if kind in (4, 5, 6):
        n, at = _varint(data, at)
        return (n >> 1) ^ -(n & 1), at
    if kind == 7:
        return struct.unpack_from("<d", data, at)[0], at + 8
    if kind == 8:
        n, at = _varint(data, at)
        return data[at : at + n], at + n
    if kind in (9, 10):
        n, inner, at = data[at] >> 4, data[at] & 15, at + 1
        if n == 15:
            n, at = _varint(data, at)
        out = []
        for _ in range(n):
            x, at = _value(data, at, inner)
            out.append(x)
        return out, at
    if kind == 11:
        n, at = _varint(data, at)
        pairs = []
        if n:
            k, v, at = data[at] >> 4, data[at] & 15, at + 1
            for _ in range(n):
                x, at = _value(data, at, k)
                y, at = _value(data, at, v)
                pairs.append((x, y))
        return pairs, at
    return fields(data, at)


def fields(data: bytes, at: int = 0) -> tuple[dict[int, object], int]:
    """A structure of the compact protocol as {field id: value}, and where it ends."""
    out: dict[int, object] = {}
    last = 0
    while data[at]:
        step, kind = data[at] >> 4, data[at] & 15
        at += 1
        if step:
            last += step
        else:
            n, at = _varint(data, at)
            last = (n >> 1) ^ -(n & 1)
        if kind in (1, 2):  # a truth value sits in its field's header
            out[last] = kind == 1
        else:
            out[last], at = _value(data, at, kind)
    return out, at + 1


class ColumnFile:
    """A Parquet file, opened for its footer, dictionary pages and single chunks."""

    def __init__(self, path: str):
        u = urlparse(path)
        if u.scheme in ("", "file"):
            self.fs, self.inner = pafs.LocalFileSystem(), unquote(u.path or path)
        else:
            self.fs, self.inner = pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
        self.raw = self.fs.open_input_file(self.inner)
        self.file = pq.ParquetFile(self.raw)
        self.meta = self.file.metadata
        self.at = {self.meta.schema.column(i).path: i for i in range(self.meta.num_columns)}

    @cached_property
    def _groups(self) -> list:
        """Row groups as the footer has them, for what the library leaves out."""
        end = self.raw.size()
        self.raw.seek(end - 8)
        n = struct.unpack("<I", self.raw.read(4))[0]
        self.raw.seek(end - 8 - n)
        return fields(self.raw.read(n))[0][4]

    def coded(self, group: int, column: str) -> bool:
        """Whether the footer says that every page of values of the chunk is coded by its dictionary."""
        c = self.meta.row_group(group).column(self.at[column])
        if not c.has_dictionary_page:
            return False
        pages = self._groups[group][1][self.at[column]][3].get(13)
        return bool(pages) and all(p[1] == DICTIONARY_PAGE or p[2] in BY_DICTIONARY for p in pages)

    def logical(self, column: str) -> dict:
        return json.loads(self.meta.schema.column(self.at[column]).logical_type.to_json())

    def statistics(self, group: int, column: str) -> tuple[int, int | None, str | None, str | None, int | None, int | None]:
        """(rows, nulls, least, greatest, least day, greatest day) of a chunk; None for what its footer lacks.

        Extrema are texts (days as year-month-day with four digits of the year); dates and timestamps also come as days since 1970,
        which compare rightly in any year. Extrema of floating numbers say nothing about NaN.
        """
        c = self.meta.row_group(group).column(self.at[column])
        s = c.statistics
        nulls = s.null_count if s is not None and s.has_null_count else None
        lo = hi = lo_day = hi_day = None
        if s is not None and s.has_min_max:
            kind = self.logical(column)
            raw = s.min_raw, s.max_raw
            if c.physical_type == "BYTE_ARRAY":
                if kind["Type"] == "String" and max(map(len, raw)) < EXACT_TEXT:
                    lo, hi = (x.decode("utf-8", "replace") for x in raw)
            elif kind["Type"] in ("Timestamp", "Date") and c.physical_type in ("INT64", "INT32"):
                unit = DAY_UNITS[kind["timeUnit"]] if kind["Type"] == "Timestamp" else 1
                lo_day, hi_day = (x // unit for x in raw)
                lo, hi = map(day_text, (lo_day, hi_day))
            elif c.physical_type in ("DOUBLE", "FLOAT", "INT32", "INT64") and kind["Type"] in ("None", "Int"):
                lo, hi = map(str, raw)
        return c.num_values, nulls, lo, hi, lo_day, hi_day

    def dictionary(self, group: int, column: str) -> pa.Array | None:
        """The distinct values of a chunk, from its dictionary page alone; None where that does not hold them all or is of another kind."""
        if not self.coded(group, column):
            return None
        c = self.meta.row_group(group).column(self.at[column])
        self.raw.seek(c.dictionary_page_offset)
        data = self.raw.read(HEADER)
        head, begin = fields(data)
        self.raw.seek(c.dictionary_page_offset + begin)
        page = self.raw.read(head[3])
        try:
            if c.compression != "UNCOMPRESSED":
                page = pa.Codec(c.compression.lower()).decompress(page, head[2], asbytes=True)
        except (ValueError, OSError, pa.ArrowException):
            return None
        n = head[7][1]
        kind = self.logical(column)
        if c.physical_type == "BYTE_ARRAY" and kind["Type"] == "String":
            ends, at, parts = [0], 0, []
            for _ in range(n):
                size = int.from_bytes(page[at : at + 4], "little")
                parts.append(page[at + 4 : at + 4 + size])
                ends.append(ends[-1] + size)
                at += 4 + size
            return pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(struct.pack(f"<{n + 1}q", *ends)), pa.py_buffer(b"".join(parts))])
        if c.physical_type == "DOUBLE":
            return pa.Array.from_buffers(pa.float64(), n, [None, pa.py_buffer(page)])
        if c.physical_type == "INT64" and kind["Type"] in ("None", "Timestamp"):
            ints = pa.Array.from_buffers(pa.int64(), n, [None, pa.py_buffer(page)])
            return ints if kind["Type"] == "None" else ints.view(pa.timestamp(ARROW_UNITS[kind["timeUnit"]]))
        if c.physical_type == "INT32" and kind["Type"] in ("None", "Date"):
            ints = pa.Array.from_buffers(pa.int32(), n, [None, pa.py_buffer(page)])
            return ints if kind["Type"] == "None" else ints.view(pa.date32())
        return None

    def chunk(self, group: int, columns: list[str]) -> pa.Table:
        """The values of some columns in a row group."""
        return self.file.read_row_group(group, columns=columns)

    def distinct(self, group: int, column: str) -> pa.Array:
        """The distinct non-null values of a chunk: of its dictionary page, or of its values where that does not suffice."""
        got = self.dictionary(group, column)
        return got if got is not None else self.chunk(group, [column]).column(0).combine_chunks().unique().drop_null()


def day_text(day: int) -> str | None:
    try:
        return (dt.date(1970, 1, 1) + dt.timedelta(days=day)).isoformat()
    except OverflowError:
        return None
