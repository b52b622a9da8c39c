"""Files of independent Zstandard frames with a seek table at the end (the public seekable format)."""

from __future__ import annotations

import struct
import uuid

import pyarrow.fs as pafs
import xxhash
import zstandard

#: Fixed values of the format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC, CHECKSUM_FLAG = 0x184D2A5E, 0x8F92EAB1, 0x80


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder given as a URI or a local path; works on executors."""
    if "://" in uri or uri.startswith("file:"):
        return pafs.FileSystem.from_uri("file://" + uri.removeprefix("file:") if uri.startswith("file:/") and not uri.startswith("file://") else uri)
    return pafs.LocalFileSystem(), uri


class SeekableWriter:
    """Writes frames one after another and the seek table on closing. The name of the file is new for every attempt.

    A task that is run again, or twice, thus never touches what another attempt wrote; readers learn the name of the
    file from the rows of the attempt that ended well.
    """

    def __init__(self, folder: str, suffix: str, level: int = 3) -> None:
        self.system, path = open_folder(folder)
        self.system.create_dir(path, recursive=True)
        self.name = f"{uuid.uuid4().hex}{suffix}"
        self.stream = self.system.open_output_stream(f"{path}/{self.name}", compression=None)
        self.compress = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True).compress
        self.entries: list[tuple[int, int, int]] = []

    def frame(self, data: bytes) -> int:
        """Adds a frame and returns its number."""
        packed = self.compress(data)
        self.stream.write(packed)
        self.entries.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        return len(self.entries) - 1

    def close(self) -> None:
        body = b"".join(struct.pack("<III", *e) for e in self.entries) + struct.pack("<IBI", len(self.entries), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.stream.write(struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body)
        self.stream.close()


class SeekableReader:
    """Reads single frames of a file by its seek table and checks their sums."""

    def __init__(self, folder: str, name: str) -> None:
        system, path = open_folder(folder)
        self.file = system.open_input_file(f"{path}/{name}")
        size = self.file.size()
        count, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"no seek table in {name}")
        width = 12 if flags & CHECKSUM_FLAG else 8
        head = struct.unpack("<II", self._at(size - 9 - width * count - 8, 8))
        if head != (SKIPPABLE_MAGIC, width * count + 9):
            raise ValueError(f"broken seek table in {name}")
        table = self._at(size - 9 - width * count, width * count)
        self.entries, start = [], 0
        for k in range(count):
            packed, plain = struct.unpack_from("<II", table, width * k)
            total = struct.unpack_from("<I", table, width * k + 8)[0] if width == 12 else None
            self.entries.append((start, packed, plain, total))
            start += packed

    def _at(self, start: int, length: int) -> bytes:
        self.file.seek(start)
        return self.file.read(length)

    def frame(self, number: int) -> bytes:
        start, packed, plain, total = self.entries[number]
        data = zstandard.ZstdDecompressor().decompress(self._at(start, packed), max_output_size=plain)
        if len(data) != plain or total is not None and xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != total:
            raise ValueError(f"frame {number} is damaged")
        return data

    def close(self) -> None:
        self.file.close()


