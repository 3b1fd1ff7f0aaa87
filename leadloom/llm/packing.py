"""Packing documents into fixed token windows by best-fit decreasing.

Overlong documents are first cut into full windows. The remaining pieces are dealt to groups of bounded size by a
hash; each group is packed on its own, longest piece first, into the open window with the least room that still
fits. A segment tree over remaining capacities finds that window in as many steps as the window length has bits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.llm.scratch import materialize, table
from leadloom.llm.tokens import word_ids

WINDOW = 4096
END_ID = 2
VOCABULARY = "word_bpe_49k.json"
#: Pieces of a packing group on average; a group leaves about one window partly open.
GROUP_PIECES = 4096
#: Documents encoded before their pieces are handed on.
BLOCK = 500


class RoomTree:
    """Open windows by remaining capacity; finds the least capacity that holds a length."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()  # leaves 0..window
        self.count = [0] * (2 * self.size)
        self.open: dict[int, list[int]] = {}

    def put(self, room: int, sequence: int) -> None:
        self.open.setdefault(room, []).append(sequence)
        at = room + self.size
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """(sequence, room) of the tightest open window with room for ``length``, removed from the tree."""
        at = length + self.size
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        room = at - self.size
        while at:
            self.count[at] -= 1
            at >>= 1
        return self.open[room].pop(), room


def best_fit_decreasing(lengths: list[int], window: int) -> list[tuple[int, int]]:
    """(sequence, offset) of each of ``lengths``, which come longest first."""
    tree, placed, n = RoomTree(window), [], 0
    for length in lengths:
        found = tree.take(length)
        if found is None:
            found, n = (n, window), n + 1
        sequence, room = found
        placed.append((sequence, window - room))
        if room > length:
            tree.put(room - length, sequence)
    return placed


def pieces(
    docs: DataFrame, window: int = WINDOW, end_id: int = END_ID, vocabulary: str = VOCABULARY, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, start, length, ids (binary, little-endian unsigned 32-bit) and doc_tokens of each piece of each document.

    A null or empty text is the end id alone. Repeated rows give repeated pieces; other columns are not read.
    """

    def of_batches(batches):
        import numpy as np
        import pyarrow as pa

        end = np.array([end_id], dtype="<u4").tobytes()
        for whole in batches:
            for lo in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(lo, BLOCK)
                rows = []
                for k, ids in enumerate(word_ids(batch.column(1).to_pylist(), vocabulary, folder)):
                    ids += end
                    n = len(ids) // 4
                    rows += [(k, at, min(window, n - at), ids[4 * at : 4 * (at + window)], n) for at in range(0, n, window)]
                k, start, length, ids, total = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(k)), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary()), pa.array(total, pa.int64())],
                    names=["doc_id", "start", "length", "ids", "doc_tokens"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint"
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(of_batches, schema)


def assign_sequences(cut: DataFrame, window: int = WINDOW, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """The rows of ``cut`` (a stored table: doc_id, start, length and any others) with sequence_id and offset; ``cut`` is read twice.

    Pieces are dealt by their place in the table, so groups are of one size whatever ids are null or repeat. Ties of
    length go by doc_id, nulls last, then start; of rows that repeat both, either may come first.
    """
    groups = max(1, -(-cut.count() // group_pieces))
    dealt = cut.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

    def pack(rows):
        import pyarrow as pa

        rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        placed = best_fit_decreasing(rows.column("length").to_pylist(), window)
        group = rows.column("_group")[0].as_py() << 32 if len(rows) else 0
        out = rows.drop_columns(["_group"])
        out = out.append_column("sequence_id", pa.array([group + s for s, _ in placed], pa.int64()))
        return out.append_column("offset", pa.array([o for _, o in placed], pa.int64()))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields)
    return dealt.groupBy("_group").applyInArrow(pack, f"{fields}, sequence_id bigint, offset bigint")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their windows, as ``packed_digest`` defines them; null and empty texts are their end token only."""
    return packed_digest(table(spark, sf_dir, "documents"))


def packed_digest(docs: DataFrame) -> DataFrame:
    cut = pieces(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    packed = assign_sequences(materialize(cut, "pieces"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
