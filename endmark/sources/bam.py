"""A data source for BAM files: spark.dataSource.register(BamSource); spark.read.format("bam").load(path).

BGZF is a series of gzip members, so the standard library decodes it. A file is one partition; CRAM has no decoder here and is refused.
The path must be one that executors can open as a file.
"""

from __future__ import annotations

import glob
import gzip
import struct
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "name string, flag int, contig string, start long, mapq int, cigar array<struct<op:int,len:int>>, sequence string, hits int"
BASES = "=ACMGRSVTWYHKDBN"
_SIZES = {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}


def _tag(data: bytes, wanted: bytes) -> int | None:
    """An integer tag's value."""
    at = 0
    while at + 3 <= len(data):
        key, kind, at = data[at : at + 2], chr(data[at + 2]), at + 3
        if kind in "ZH":
            at = data.index(0, at) + 1
        elif kind == "B":
            at += 5 + _SIZES[chr(data[at])] * struct.unpack_from("<i", data, at + 1)[0]
        else:
            if key == wanted and kind in "cCsSiI":
                return struct.unpack_from("<" + {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I"}[kind], data, at)[0]
            at += _SIZES[kind]
    return None


def records(path: str) -> Iterator[tuple]:
    """All records of a file in order, unmapped ones included."""
    with gzip.open(path) as f:
        if f.read(4) != b"BAM\x01":
            raise ValueError(f"{path} isn't a BAM file")
        f.read(struct.unpack("<i", f.read(4))[0])
        names = []
        for _ in range(struct.unpack("<i", f.read(4))[0]):
            names.append(f.read(struct.unpack("<i", f.read(4))[0])[:-1].decode())
            f.read(4)
        while head := f.read(4):
            data = f.read(struct.unpack("<i", head)[0])
            ref, start, n_name, mapq, _, n_cigar, flag, n_seq, _, _, _ = struct.unpack_from("<iiBBHHHiiii", data)
            at = 32 + n_name
            cigar = [(x & 15, x >> 4) for x in struct.unpack_from(f"<{n_cigar}I", data, at)]
            at += 4 * n_cigar
            packed = data[at : at + (n_seq + 1) // 2]
            seq = "".join(BASES[b >> 4] + BASES[b & 15] for b in packed)[:n_seq]
            yield data[32 : 32 + n_name - 1].decode(), flag, names[ref] if ref >= 0 else None, start, mapq, cigar, seq, _tag(data[at + len(packed) + n_seq :], b"NH")


class BamReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        if self.path.endswith(".cram"):
            raise ValueError("CRAM needs a decoder that isn't available; convert it to BAM")
        return [InputPartition(p) for p in sorted(glob.glob(self.path))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        return records(partition.value)


class BamSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BamReader:
        return BamReader(self.options["path"])
