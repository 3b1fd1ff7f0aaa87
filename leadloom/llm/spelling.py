"""Groups of spelling variants: words one edit apart, found in positional q-gram indexes.

Words are counted in their tasks before they are shuffled. One edit spoils one third of a word at most, so near words share
two of their three parts at fixed places: those two parts and the shorter length deal the words out, six rows for each. Words dealt alike
go into an index of bigrams by place and length; a word's postings (places at most one off, lengths of the pair only) are merged
through a heap, and who meets often enough is verified: one edit spoils two bigrams, so words of lengths a and b share
max(a, b) - 3 at least.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.llm.scratch import materialize, table

RUN = "[A-Za-zÀ-ÿ]+"
#: One occurrence in SPOILED loses a letter, by the checksum of its document and itself.
SPOILED = 199
MIN_LENGTH, MIN_COUNT, FORM_FACTOR = 6, 5, 5
Q = 2
#: Distinct words that a task counts before it hands them on.
COUNTED_WORDS = 500_000
MAX_ROUNDS = 64


def spoiled(doc_id, run: str) -> str:
    """The lower-cased ``run`` of document ``doc_id`` (none for null), without one letter where the checksum says so."""
    from zlib import crc32

    h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    return run if h % SPOILED else run[: h % len(run)] + run[h % len(run) + 1 :]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word and n: how often each word of at least MIN_LENGTH code points occurs in all texts."""

    def count(batches):
        import re
        from collections import Counter
        from zlib import crc32

        import pyarrow as pa

        find, total = re.compile(RUN).findall, Counter()

        def flush():
            made = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return made

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if (text := text.as_py()) is None:
                    continue
                begun = crc32(f"{'' if doc_id is None else doc_id}:".encode())
                # encoding lower-cases A-Z only
                for run, n in Counter(find(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))).items():
                    if len(run) >= MIN_LENGTH:
                        total[run if crc32(run.encode(), begun) % SPOILED else spoiled(doc_id, run)] += n
                if len(total) > COUNTED_WORDS:
                    yield flush()
        yield flush()

    counted = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).mapInArrow(count, "word string, n bigint")
    return counted.where(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.sum("n").alias("n"))


def one_edit(a: str, b: str) -> bool:
    """Whether ``a`` and ``b`` differ by exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


class GramIndex:
    """Words of one or two lengths by bigram, place and length, each posting in the order of arrival."""

    def __init__(self):
        self.words: list[str] = []
        self.postings: dict = {}

    def near(self, word: str, length: int) -> list[int]:
        """Words of ``length`` that share enough bigrams with ``word``, places at most one off, and prove one edit away."""
        from heapq import merge
        from itertools import groupby

        lists = [p for k in range(len(word) - Q + 1) for d in (-1, 0, 1) if (p := self.postings.get((word[k : k + Q], k + d, length)))]
        bound = max(len(word), length) - Q + 1 - Q
        return [i for i, met in groupby(merge(*lists)) if sum(1 for _ in met) >= bound and one_edit(word, self.words[i])]

    def add(self, word: str) -> None:
        self.words.append(word)
        for k in range(len(word) - Q + 1):
            self.postings.setdefault((word[k : k + Q], k, len(word)), []).append(len(self.words) - 1)


def near_pairs(words: DataFrame) -> DataFrame:
    """word, near, near_n: both directions of each pair of ``words`` (word, n; each word once) that are one edit apart."""
    size = F.length("word")

    def dealt(short):
        a, b = F.floor(short / 3), F.floor(2 * short / 3)
        head, tail = F.substring(F.col("word"), F.lit(1), b), F.substring(F.col("word"), size - short + a + 1, short)
        outer = F.concat(F.substring(F.col("word"), F.lit(1), a), F.substring(F.col("word"), size - short + b + 1, short))
        return [F.struct(short.alias("short"), F.lit(k).alias("part"), x.alias("key")) for k, x in enumerate((head, tail, outer))]

    postings = words.select("word", "n", F.explode(F.array(*dealt(size), *dealt(size - 1))).alias("at")).select("word", "n", "at.*")

    def pairs(batches):
        import pyarrow as pa

        group, index, counts, out = None, None, [], []
        for batch in batches:
            for word, n, short, part, key in zip(*(c.to_pylist() for c in batch.columns)):
                if group != (short, part, key):
                    group, index, counts = (short, part, key), GramIndex(), []
                for length in {short, 2 * short + 1 - len(word)}:  # the shorter of a pair has the length of the group
                    for i in index.near(word, length):
                        out += [(word, index.words[i], counts[i]), (index.words[i], word, n)]
                index.add(word)
                counts.append(n)
            columns = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())], names=["word", "near", "near_n"])
            out = []

    keys = ["short", "part", "key"]
    together = postings.repartition(*keys).sortWithinPartitions(*keys)
    return together.mapInArrow(pairs, "word string, near string, near_n bigint").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word and root of every row of ``forms`` (word, form): forms followed to the last, by jumping over the words between."""
    at = materialize(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    for _ in range(MAX_ROUNDS):
        further = at.where("word <> root").select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = materialize(at.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if at.where("moved").isEmpty():
            return at.select("word", "root")
        at = at.drop("moved")
    raise RuntimeError(f"forms still lead on after {MAX_ROUNDS} rounds")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_count: int = MIN_COUNT, factor: int = FORM_FACTOR) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of MIN_LENGTH code points and ``min_count`` occurrences or more.

    A word's form is its near word of largest n (of equal ones, the first in code-point order) if that is ``factor`` times its own or
    more. A null id counts as an empty one in the checksum, a null or empty text has no words, repeated rows count again, an
    empty table gives no rows, texts count whole, and other columns are not read.
    """
    words = materialize(word_counts(docs, id_col, text_col).where(F.col("n") >= min_count), "words")
    first = F.min_by("near", F.struct((-F.col("near_n")).alias("most"), "near")).alias("near")
    best = near_pairs(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.max("near_n").alias("near_n"), first)
    led = F.col("near_n") >= factor * F.col("n")
    found = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(led, F.col("near")).alias("form"), F.when(led, F.col("near_n")).alias("form_n"))
    found = materialize(found, "forms")
    return found.join(roots(found), "word").select("word", "form", "root", "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """word, form, root, n, n_near and form_n of the words of all documents, as ``spelling_variants`` defines them."""
    return spelling_variants(table(spark, sf_dir, "documents"))
