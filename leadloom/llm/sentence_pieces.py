"""SentencePiece encoding and decoding, with a max-plus parallel scan for giant documents.

The library encodes documents of ordinary length. A giant document is split into chunks. The state at a chunk's
boundary is the piece that crosses it; the transfer matrix of a chunk has, for each state at its start and
each at its end, the best weight of a path of pieces between them. For the merging (BPE) model a path has weight 0 if
all its neighbours are pieces that merging leaves apart, else minus infinity: a string has one such
path, which is the model's encoding. Matrices are combined associatively, which tells every chunk its two states, and
each chunk then traces its own path back.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.llm.scratch import materialize, table
from leadloom.llm.tokens import tokenizer_path

VOCABULARY = "piece_bpe_32k.model"
BLANK = "▁"
CHUNK_CHARS = 65_536
#: Documents of ordinary length that are encoded at a time.
BLOCK = 200
#: Word pairs whose compatibility a worker remembers.
MAX_REMEMBERED = 200_000
NEVER = float("-inf")
START = (-1, 0)


class Model:
    """Pieces and scores of a merging SentencePiece model that keeps white space."""

    def __init__(self, name: str, folder: str | None):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(name, folder))
        lib = self.library
        plain = [i for i in range(lib.get_piece_size()) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i))]
        self.id_of = {lib.id_to_piece(i): i for i in plain}
        self.score = {lib.id_to_piece(i): lib.get_score(i) for i in plain}
        self.byte_id = {int(lib.id_to_piece(i)[3:5], 16): i for i in range(lib.get_piece_size()) if lib.is_byte(i)}
        self.longest = max(map(len, self.id_of))
        self.apart: dict[tuple[str, str], bool] = {}

    def merge(self, s: str) -> list[str]:
        """The pieces of a short string: the best-scored neighbours merge first, the leftmost of equals."""
        parts = list(s)
        while len(parts) > 1:
            best = max(((self.score[parts[k] + parts[k + 1]], -k) for k in range(len(parts) - 1) if parts[k] + parts[k + 1] in self.score), default=None)
            if best is None:
                break
            k = -best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def compatible(self, a: str, b: str) -> bool:
        """Whether merging leaves ``a`` and ``b`` as neighbours; an empty ``a`` stands for the start of the text."""
        known = self.apart.get((a, b))
        if known is None:
            if len(self.apart) > MAX_REMEMBERED:
                self.apart.clear()
            known = self.apart[a, b] = self.merge(a + b) == ([a, b] if a else [b])
        return known

    def ids(self, piece: str) -> list[int]:
        found = self.id_of.get(piece)
        return [found] if found is not None else [self.byte_id[x] for x in piece.encode("utf-8")]

    def spans(self, s: str, at: int):
        """Ends of the pieces that start at ``at``; a single character always is one."""
        return [e for e in range(at + 1, min(len(s), at + self.longest) + 1) if e == at + 1 or s[at:e] in self.id_of]


@lru_cache(maxsize=2)
def model(name: str, folder: str | None = None) -> Model:
    return Model(name, folder)


def normalised(text: str) -> str:
    return BLANK + text.replace(" ", BLANK) if text else ""


class Chunk:
    """Piece starts in [lo, hi) of a normalised document; ``s`` is that part with some context, which begins at ``origin``."""

    def __init__(self, m: Model, s: str, origin: int, lo: int, hi: int, last: bool):
        self.m, self.s, self.o, self.lo, self.hi, self.last = m, s, origin, lo, hi, last
        inner = range(lo + 1, hi)
        breaks = lambda k: s[k - origin] == BLANK and s[k - origin - 1] != BLANK  # noqa: E731  every path has a boundary here
        self.first_break = next((k for k in inner if breaks(k)), None)
        self.last_break = next((k for k in reversed(inner) if breaks(k)), None)

    def crossing(self, at: int) -> list[tuple[int, int]]:
        """Pieces that start before ``at`` and end there or beyond."""
        s, o = self.s, self.o
        starts = range(max(o, at - self.m.longest), at)
        return [(p, o + e) for p in starts for e in self.m.spans(s, p - o) if o + e >= at]

    def sources(self) -> list[tuple[int, int]]:
        return [START] if self.lo == 0 else self.crossing(self.lo)

    def forward(self, states: list[tuple[int, int]], goal: int, past: bool):
        """Back pointers of all paths from ``states``: to pieces that end at ``goal``, or, if ``past``, that cross it.

        Masks hold, as bits, the states that a piece is reached from."""
        s, o, m = self.s, self.o, self.m
        at: dict[int, dict[tuple[int, int], int]] = {}
        for bit, span in enumerate(states):
            at.setdefault(span[1], {})[span] = at.get(span[1], {}).get(span, 0) | 1 << bit
        back: dict[tuple[int, int], list[tuple[tuple[int, int], int]]] = {}
        goals: dict[tuple[int, int], int] = {}
        for pos in range(min(at), goal):
            for span, mask in at.pop(pos, {}).items():
                left = s[span[0] - o : span[1] - o] if span[0] >= 0 else ""
                for end in m.spans(s, pos - o):
                    nxt = (pos, o + end)
                    if nxt[1] > goal and not past or not m.compatible(left, s[pos - o : end]):
                        continue
                    back.setdefault(nxt, []).append((span, mask))
                    into = goals if nxt[1] >= goal else at.setdefault(nxt[1], {})
                    into[nxt] = into.get(nxt, 0) | mask
        for span, mask in at.get(goal, {}).items():
            goals[span] = goals.get(span, 0) | mask
        return back, goals

    def transfer(self) -> list[tuple[tuple[int, int], tuple[int, int]]]:
        """The entries of the transfer matrix that are not minus infinity: (state at the start, state at the end)."""
        states = self.sources()
        if self.first_break is None:
            _, goals = self.forward(states, self.hi, not self.last)
            return [(states[b], g) for g, mask in goals.items() for b in range(len(states)) if mask >> b & 1]
        _, head = self.forward(states, self.first_break, False)
        alive = 0
        for mask in head.values():
            alive |= mask
        _, tail = self.forward([(self.last_break, self.last_break)], self.hi, not self.last)
        return [(st, g) for b, st in enumerate(states) if alive >> b & 1 for g in tail]

    def _trace(self, states, start, goal, past, target) -> list[tuple[int, int]]:
        back, goals = self.forward(states, goal, past)
        bit = states.index(start)
        at = target if target is not None else next(g for g, mask in goals.items() if mask >> bit & 1)
        path = []
        while at != start:
            path.append(at)
            at = next(prev for prev, mask in back[at] if mask >> bit & 1)
        return path[::-1]

    def encode(self, start: tuple[int, int], end: tuple[int, int]) -> list[int]:
        """Ids of the pieces after state ``start`` up to state ``end``."""
        states, ids = self.sources(), []
        of = lambda spans: [i for p, q in spans for i in self.m.ids(self.s[p - self.o : q - self.o])]
        if self.first_break is None:
            return of(self._trace(states, start, self.hi, not self.last, end))
        ids += of(self._trace(states, start, self.first_break, False, None))
        middle = self.s[self.first_break + 1 - self.o : self.last_break - self.o].replace(BLANK, " ")
        if self.last_break > self.first_break:
            ids += self.m.library.encode(middle)  # the library adds the blank before it again
        here = (self.last_break, self.last_break)
        return ids + of(self._trace([here], here, self.hi, not self.last, end))


def combine(a, b):
    """Max-plus product of two transfer matrices given as {(from, to): weight}."""
    by: dict = {}
    for (x, y), w in b.items():
        by.setdefault(x, []).append((y, w))
    out: dict = {}
    for (x, y), w in a.items():
        for z, v in by.get(y, ()):
            out[x, z] = max(out.get((x, z), NEVER), w + v)
    return out


def scan(matrices: list[dict]) -> list[tuple[tuple[int, int], tuple[int, int]]]:
    """The states at both ends of each chunk, on the best path through all of them."""
    prefix = [matrices[0]]
    for m in matrices[1:]:
        prefix.append(combine(prefix[-1], m))
    (_, end), _ = max(prefix[-1].items(), key=lambda e: e[1])
    states = []
    for k in range(len(matrices) - 1, -1, -1):
        options = [x for (x, y) in matrices[k] if y == end]
        start = START if k == 0 else next(x for x in options if (START, x) in prefix[k - 1])
        states.append((start, end))
        end = start
    return states[::-1]


def encode(text: str | None, name: str = VOCABULARY, folder: str | None = None) -> list[int]:
    return model(name, folder).library.encode(text) if text else []


def decode(ids: list[int], name: str = VOCABULARY, folder: str | None = None) -> str:
    return model(name, folder).library.decode(ids) if ids else ""


def _cut(giant: DataFrame, chunk: int, context: int) -> DataFrame:
    """key, of, k, lo, hi, origin and part (with context on both sides) of the chunks of normalised texts ``s``."""
    n = F.length("s")
    of = F.greatest(F.floor(n / F.lit(chunk)), F.lit(1)).cast("int")
    cut = giant.select("key", "s", of.alias("of")).select("key", "of", "s", F.explode(F.sequence(F.lit(0), F.col("of") - 1)).alias("k"))
    lo = F.col("k") * chunk
    hi = F.when(F.col("k") == F.col("of") - 1, F.length("s")).otherwise(lo + chunk)
    origin = F.greatest(lo - context, F.lit(0))
    cut = cut.select("key", "of", "k", lo.alias("lo"), hi.alias("hi"), origin.alias("origin"), "s")
    part = F.substring(F.col("s"), F.col("origin") + 1, F.col("hi") + context - F.col("origin"))
    return cut.select("key", "of", "k", "lo", "hi", "origin", part.alias("part")).repartition("key", "k")


_SPAN = "struct<p:int,q:int>"


def _chunk(m: Model, x: dict) -> Chunk:
    return Chunk(m, x["part"], x["origin"], x["lo"], x["hi"], x["k"] == x["of"] - 1)


def encode_giants(texts: DataFrame, name: str = VOCABULARY, folder: str | None = None, chunk: int = CHUNK_CHARS) -> DataFrame:
    """key, k and ids (binary, little-endian unsigned 32-bit) of the chunks of each distinct ``key`` with its ``text``."""
    giant = texts.select("key", F.concat(F.lit(BLANK), F.replace(F.col("text"), F.lit(" "), F.lit(BLANK))).alias("s"))
    context = 2 * model(name, folder).longest
    cut = _cut(giant, chunk, context)

    def span_type():
        import pyarrow as pa

        return pa.struct([("p", pa.int32()), ("q", pa.int32())])

    def transfers(batches):
        import pyarrow as pa

        m = model(name, folder)
        for batch in batches:
            rows = batch.to_pylist()
            entries = [[{"i": {"p": a[0], "q": a[1]}, "o": {"p": b[0], "q": b[1]}} for a, b in _chunk(m, x).transfer()] for x in rows]
            kind = pa.list_(pa.struct([("i", span_type()), ("o", span_type())]))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("k"), pa.array(entries, kind)], names=["key", "k", "entries"])

    matrices = materialize(cut.mapInArrow(transfers, f"key binary, k int, entries array<struct<i:{_SPAN},o:{_SPAN}>>"), "piece-transfers")

    def solve(rows):
        import pyarrow as pa

        rows = rows.sort_by("k")
        tup = lambda d: (d["p"], d["q"])
        states = scan([{(tup(e["i"]), tup(e["o"])): 0.0 for e in es} for es in rows.column("entries").to_pylist()])
        spans = lambda j: pa.array([{"p": st[j][0], "q": st[j][1]} for st in states], span_type())
        return pa.table({"key": rows.column("key"), "k": rows.column("k"), "i": spans(0), "o": spans(1)})

    # One row of a few entries for each chunk: the matrices of even the longest text that a row can hold are small.
    solved = matrices.dropDuplicates(["key", "k"]).groupBy("key").applyInArrow(solve, f"key binary, k int, i {_SPAN}, o {_SPAN}")
    solved = materialize(solved, "piece-states")

    def trace(batches):
        import numpy as np
        import pyarrow as pa

        m = model(name, folder)
        for batch in batches:
            rows = batch.to_pylist()
            ids = [np.array(_chunk(m, x).encode((x["i"]["p"], x["i"]["q"]), (x["o"]["p"], x["o"]["q"])), dtype="<u4").tobytes() for x in rows]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("k"), pa.array(ids, pa.binary())], names=["key", "k", "ids"])

    traced = cut.join(solved, ["key", "k"]).mapInArrow(trace, "key binary, k int, ids binary")
    return materialize(traced, "piece-ids").dropDuplicates(["key", "k"])


def encode_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = VOCABULARY, folder: str | None = None, chunk: int = CHUNK_CHARS
) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit) and decoded (the text that they give back) of each row.

    Null and empty texts have no ids and decode to the empty text. Repeated rows give a row each; other columns are not
    read. A text with the model's own blank sign decodes to a plain blank there.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()

    def whole(batches):
        import numpy as np
        import pyarrow as pa

        m = model(name, folder)
        for whole_batch in batches:
            for lo in range(0, whole_batch.num_rows, BLOCK):
                batch = whole_batch.slice(lo, BLOCK)
                ids = m.library.encode(batch.column(1).to_pylist(), num_threads=1)
                texts = m.library.decode(ids, num_threads=1)
                packed = pa.array([np.array(x, dtype="<u4").tobytes() for x in ids], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), packed, pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])

    schema = f"doc_id {kind}, ids binary, decoded string"
    short = rows.where(F.length("text") <= chunk).mapInArrow(whole, schema)
    giant = rows.where(F.length("text") > chunk).withColumn("key", F.unhex(F.sha2("text", 256)))
    parts = encode_giants(giant.select("key", "text"), name, folder, chunk)

    def join_up(table):
        import numpy as np
        import pyarrow as pa

        table = table.sort_by("k")
        ids = b"".join(table.column("ids").to_pylist())
        text = model(name, folder).library.decode(np.frombuffer(ids, dtype="<u4").tolist())
        return pa.table({"key": table.column("key").slice(0, 1), "ids": pa.array([ids], pa.binary()), "decoded": pa.array([text], pa.string())})

    joined = parts.groupBy("key").applyInArrow(join_up, "key binary, ids binary, decoded string")
    return short.unionByName(giant.select("doc_id", "key").join(joined, "key").select("doc_id", "ids", "decoded"))


def op8_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoding of every document, as ``encode_documents`` defines it; null and empty texts have no pieces."""
    docs = table(spark, sf_dir, "documents")
    found = encode_documents(docs)
    return found.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_pieces"),
        F.crc32("ids").alias("ids_crc32"),
        F.length("decoded").cast("long").alias("decoded_chars"),
        F.md5("decoded").alias("decoded_md5"),
    )
