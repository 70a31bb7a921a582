"""Metadata of video files from their containers' headers, as a Spark data source.

``spark.read.format("videos").load(folder)`` gives a row for each file, also for those
that can't be read, with the error. Files are dealt to partitions by number; of a file
only the boxes on the way to its tracks are read, whatever its length. Folders are
reached as pyarrow does (a local path or a URI of a store that it knows)."""

from __future__ import annotations

import posixpath
import struct
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Suffixes of videos in this container format, and boxes that hold boxes.
SUFFIXES, HOLDERS = ("mp4", "mov", "m4v"), (b"moov", b"trak", b"mdia", b"minf", b"stbl")
SCHEMA = "path string, size long, modified timestamp, duration_sec double, fps double, frame_count long, width int, height int, rotation int, video_codec string, has_audio boolean, error string"
#: A header box beyond this size isn't one.
MOST = 1 << 26


class BrokenFile(ValueError):
    """What is wrong with a file."""


def boxes(file, start: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """(type, start, end) of the contents of the boxes between two offsets."""
    while start + 8 <= end:
        file.seek(start)
        size, kind = struct.unpack(">I4s", file.read(8))
        head = 8
        if size == 1:
            size, head = struct.unpack(">Q", file.read(8))[0], 16
        elif size == 0:
            size = end - start
        if size < head or start + size > end:
            raise BrokenFile(f"box {kind.decode('latin-1')!r} at {start} doesn't fit")
        yield kind, start + head, start + size
        start += size


def content(file, start: int, end: int, at_least: int) -> bytes:
    if not at_least <= end - start <= MOST:
        raise BrokenFile(f"box at {start} has {end - start} bytes")
    file.seek(start)
    return file.read(end - start)


def clock(data: bytes) -> tuple[int, int]:
    """Time scale and duration of a movie's or a track's header, of version 0 or 1; the
    greatest duration stands for an unknown one."""
    at, kind = (20, ">IQ") if data[0] == 1 else (12, ">II")
    scale, duration = struct.unpack_from(kind, data, at)
    return scale, 0 if duration in (0xFFFFFFFF, 0xFFFFFFFFFFFFFFFF) else duration


def track(file, start: int, end: int) -> dict:
    """What a track's boxes say."""
    found: dict = {"samples": 0}

    def walk(a: int, b: int) -> None:
        for kind, x, y in boxes(file, a, b):
            if kind in HOLDERS:
                walk(x, y)
            elif kind == b"tkhd":
                data = content(file, x, y, 84)
                at = 52 if data[0] == 1 else 40
                m = struct.unpack_from(">9i", data, at)
                found["width"], found["height"] = (v >> 16 for v in struct.unpack_from(">2I", data, at + 36))
                found["rotation"] = {(0, 1): 90, (-1, 0): 180, (0, -1): 270}.get(((m[0] > 0) - (m[0] < 0), (m[1] > 0) - (m[1] < 0)), 0)
            elif kind == b"mdhd":
                found["scale"], found["duration"] = clock(content(file, x, y, 20))
            elif kind == b"hdlr":
                found["kind"] = content(file, x, y, 12)[8:12]
            elif kind == b"stsd":
                data = content(file, x, y, 8)
                found["codec"] = data[12:16].decode("latin-1").strip() if len(data) >= 16 else None
            elif kind == b"stts":
                data = content(file, x, y, 8)
                n = min(struct.unpack_from(">I", data, 4)[0], (len(data) - 8) // 8)
                found["samples"] = sum(struct.unpack_from(">I", data, 8 + 8 * i)[0] for i in range(n))

    walk(start, end)
    return found


def metadata(file, size: int) -> tuple:
    """(duration, fps, frames, width, height, rotation, codec, has_audio) of an open file.
    The rate is the first video track's samples by its own duration; where that is
    unknown the movie's counts."""
    movie, tracks = None, []
    for kind, x, y in boxes(file, 0, size):
        if kind == b"moov":
            for inner, a, b in boxes(file, x, y):
                if inner == b"mvhd":
                    movie = clock(content(file, a, b, 20))
                elif inner == b"trak":
                    tracks.append(track(file, a, b))
    if movie is None:
        raise BrokenFile("no movie header")
    video = next((t for t in tracks if t.get("kind") == b"vide"), None)
    if video is None:
        raise BrokenFile("no video stream")
    of = lambda scale, duration: duration / scale if scale else 0.0
    duration = of(video.get("scale", 0), video.get("duration", 0)) or of(*movie)
    fps = video["samples"] / duration if duration > 0 else 0.0
    wide, high = video.get("width", 0), video.get("height", 0)
    return duration, fps, video["samples"], wide, high, video.get("rotation", 0), video.get("codec"), any(t.get("kind") == b"soun" for t in tracks)


class Files(InputPartition):
    def __init__(self, found: list):
        super().__init__(0)
        self.found = found


class VideoReader(DataSourceReader):
    def __init__(self, folder: str, parts: int, suffixes: tuple[str, ...]):
        self.folder, self.parts, self.suffixes = folder, parts, suffixes

    def store(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.folder) if ":" in self.folder else (fs.LocalFileSystem(), self.folder)

    def partitions(self) -> list[Files]:
        from pyarrow import fs

        store, root = self.store()
        listed = store.get_file_info(fs.FileSelector(root, recursive=True))
        found = sorted((f.path, f.size, f.mtime) for f in listed if f.type == fs.FileType.File and posixpath.splitext(f.path)[1][1:].lower() in self.suffixes)
        return [Files(found[i :: self.parts]) for i in range(min(self.parts, len(found)))] or [Files([])]

    def read(self, partition: Files) -> Iterator[tuple]:
        store, _ = self.store()
        for path, size, modified in partition.found:
            try:
                with store.open_input_file(path) as file:
                    said, error = metadata(file, size), None
            except (BrokenFile, struct.error, OSError) as e:
                said, error = (None,) * 8, str(e) or type(e).__name__
            yield (path, size, modified, *said, error)


class VideoSource(DataSource):
    """Options: path, partitions (64), suffixes (mp4,mov,m4v)."""

    @classmethod
    def name(cls) -> str:
        return "videos"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> VideoReader:
        if not self.options.get("path"):
            raise ValueError("videos needs a folder to load")
        suffixes = tuple(s.strip().lower() for s in self.options.get("suffixes", ",".join(SUFFIXES)).split(","))
        return VideoReader(self.options["path"], int(self.options.get("partitions", 64)), suffixes)


def read_videos(spark: SparkSession, folder: str, **options: str):
    """The videos' metadata below a folder; see ``VideoSource``."""
    spark.dataSource.register(VideoSource)
    return spark.read.format("videos").options(**options).load(folder)
