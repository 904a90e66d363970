"""Token-ID / binary output (operator 9).

One flat file of unsigned integer ids per partition and beside it an index of
unsigned 64-bit document offsets; partition bases are prefix sums over the
manifest, so a global position needs no renumbering of files. Files are
written under a name of the attempt and moved into place, so a repeated or
speculative task leaves one whole file. They are read back memory-mapped.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.llm.common import doc_text, ship
from lakeshore.llm.encoders import json_tokenizer_memo, with_end

MANIFEST = "manifest.json"
ID_TYPES = {2: "<u2", 4: "<u4"}


def _move_into_place(fs: pafs.FileSystem, path: str, attempt: str, write) -> None:
    temporary = f"{path}.{attempt}"
    with fs.open_output_stream(temporary) as out:
        write(out)
    fs.move(temporary, path)


def write_token_files(docs: DataFrame, folder: str, tokenizer: bytes, end_id: int, id_bytes: int = 2) -> list[dict]:
    """Encode every document, append ``end_id`` and write ids in ascending
    doc_id order below ``folder`` (a URI that all machines share; it must be
    new). Returns the manifest, also written there: one entry per partition
    with its number, documents, tokens and the base of each.

    Null text: the end id alone. Null doc_id: first. Repeated doc_ids stay
    separate documents, ordered by a hash of their text. ``id_bytes``: 2 or 4.
    The text of a special token becomes its id, as the library does by default.
    """
    spark = docs.sparkSession
    ship(spark)
    id_type = ID_TYPES[id_bytes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task = TaskContext.get()
        memo = json_tokenizer_memo(tokenizer)
        first = next(batches, None)
        if first is None:
            return
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        attempt = f"tmp-{task.taskAttemptId()}"
        doc_ids: list[int | None] = []
        lengths: list[np.ndarray] = []

        def write_ids(out) -> None:
            def chain():
                yield first
                yield from batches
            for b in chain():
                doc_ids.extend(b.column("doc_id").to_pylist())
                for ids, offsets in memo.encode(b.column("text")):
                    ids, offsets = with_end(ids, offsets, end_id)
                    if id_bytes == 2 and ids.max(initial=0) > 0xFFFF:
                        raise ValueError("an id needs more than 2 bytes")
                    lengths.append(np.diff(offsets))
                    out.write(ids.astype(id_type).data)

        def write_index(out) -> None:
            offsets = np.zeros(len(doc_ids) + 1, "<u8")
            np.cumsum(np.concatenate(lengths), out=offsets[1:])
            out.write(offsets.tobytes())
            out.write(np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes())
            out.write(np.array([d is None for d in doc_ids], "u1").tobytes())

        name = f"{root}/part-{task.partitionId():06d}"
        _move_into_place(fs, f"{name}.bin", attempt, write_ids)
        _move_into_place(fs, f"{name}.idx", attempt, write_index)
        yield pa.RecordBatch.from_pydict({"part": [task.partitionId()], "docs": [len(doc_ids)],
                                          "tokens": [sum(int(n.sum()) for n in lengths)]})

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    written = (doc_text(docs).repartitionByRange(*order).sortWithinPartitions(*order)
               .mapInArrow(run, "part long, docs long, tokens long"))
    # One small row per file that was written.
    rows = sorted(tuple(r) for r in written.collect())
    doc_base = [0, *accumulate(r[1] for r in rows)]
    token_base = [0, *accumulate(r[2] for r in rows)]
    manifest = [{"part": p, "docs": d, "tokens": t, "doc_base": db, "token_base": tb}
                for (p, d, t), db, tb in zip(rows, doc_base, token_base)]
    fs, root = pafs.FileSystem.from_uri(folder)
    fs.create_dir(root, recursive=True)
    _move_into_place(fs, f"{root}/{MANIFEST}", "tmp", lambda out: out.write(
        json.dumps({"id_bytes": id_bytes, "parts": manifest}).encode()))
    return manifest


def _mapped(fs: pafs.FileSystem, path: str) -> np.ndarray:
    """The file's bytes, memory-mapped where the file system is local to the
    machine's name space (a shared mount), read otherwise."""
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, "u1", "r") if fs.get_file_info(path).size else np.zeros(0, "u1")
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), "u1")


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """One row per document of a folder of token files, in file order: doc_id,
    start (ids of all documents before it), n_tokens, ids_crc32 (unsigned, of
    the ids as little-endian unsigned 32-bit integers), and with ``with_ids``
    the ids themselves (array<long>). One task per file."""
    ship(spark)
    fs, root = pafs.FileSystem.from_uri(folder)
    with fs.open_input_file(f"{root}/{MANIFEST}") as f:
        manifest = json.loads(f.read())
    id_bytes, parts = manifest["id_bytes"], manifest["parts"]
    id_type = ID_TYPES[id_bytes]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        for b in batches:
            for k in b.column("id").to_pylist():
                entry = parts[k]
                name, n = f"{root}/part-{entry['part']:06d}", entry["docs"]
                index = _mapped(fs, f"{name}.idx")
                offsets = index[:8 * (n + 1)].view("<u8")
                doc_ids = index[8 * (n + 1):8 * (2 * n + 1)].view("<i8")
                null = index[8 * (2 * n + 1):].astype(bool)
                tokens = _mapped(fs, f"{name}.bin").view(id_type)
                for lo in range(0, n, 4096):
                    hi = min(n, lo + 4096)
                    bounds = offsets[lo:hi + 1].astype("i8")
                    own = tokens[bounds[0]:bounds[-1]].astype("<u4")
                    cuts = (bounds - bounds[0]).tolist()
                    out = [pa.array(doc_ids[lo:hi].astype("i8"), mask=null[lo:hi]),
                           pa.array(bounds[:-1] + entry["token_base"]), pa.array(np.diff(bounds)),
                           pa.array([zlib.crc32(own[i:j]) for i, j in pairwise(cuts)], pa.int64())]
                    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                    if with_ids:
                        out.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(own.astype("i8"))))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(out, names)

    return spark.range(0, len(parts), 1, max(1, len(parts))).mapInArrow(run, schema)
