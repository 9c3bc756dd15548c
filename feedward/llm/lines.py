"""Line dedup by winnowing: later repeats of runs of lines are deleted.

The units are the lines of a document that hold a word, compared without outer blanks. A
window is a shortest run of lines with at least ``min_words`` words. The least line hash of
every window is a fingerprint, so two equal windows always share one. Fingerprints that
occur once in the corpus are dropped with their windows; what is left is joined by the hash
of the whole window, and every window but the first of its kind is deleted. Windows are
taken forwards from each line and backwards from each line, which extends a match both ways
to the ends of the repeated run: a line lies in such a window exactly if it lies in some
run of at least ``min_words`` words that stands earlier in the corpus as well.

Repeated passages of 50 words and more that begin or end within a line are found by the same
method with words for lines (``passages.py``) and cut out of their lines.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, text_portions, written
from .passages import GRAM, MIN_PASSAGE, gone_words, repeated_passages, split_words
from .simhash import text_hash

MIN_WORDS = 8
#: Blanks around a line do not count.
_BLANKS = " \t\r\x0b\x0c"


def windows(text: str, min_words: int) -> list[tuple[int, int, int, int, int, int]]:
    """(fingerprint, its line, two halves of the window's hash, first line, last line) of each window."""
    sizes, numbers, digests = [], [], []
    for number, line in enumerate(text.split("\n")):
        if size := len(line.split()):
            sizes.append(size)
            numbers.append(number)
            digests.append(xxhash.xxh3_128_digest(line.strip(_BLANKS).encode("utf-8", "surrogatepass")))
    found: set[tuple[int, int]] = set()
    end, total = 0, 0
    for start in range(len(sizes)):  # forwards: the least end for each start
        while end < len(sizes) and total < min_words:
            total += sizes[end]
            end += 1
        if total >= min_words:
            found.add((start, end))
        total -= sizes[start]
    start, total = len(sizes), 0
    for end in range(len(sizes), 0, -1):  # backwards: the greatest start for each end
        while start > 0 and total < min_words:
            start -= 1
            total += sizes[start]
        if total >= min_words:
            found.add((start, end))
        total -= sizes[end - 1]
    out = []
    for start, end in sorted(found):
        least = min(range(start, end), key=lambda i: (digests[i], -i))
        whole = digests[start] if end - start == 1 else xxhash.xxh3_128_digest(b"".join(digests[start:end]))
        out.append(
            (
                int.from_bytes(digests[least][:8], "little", signed=True),
                numbers[least],
                int.from_bytes(whole[:8], "little", signed=True),
                int.from_bytes(whole[8:], "little", signed=True),
                numbers[start],
                numbers[end - 1],
            )
        )
    return out


def repeated_runs(
    docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, text_hash, runs): the line ranges to delete of each document that has any.

    Documents come in order of id (null last), hash of the text and line. Rows that repeat id
    and text are one document and are treated alike. Of a window that overlaps the first of its
    kind in the same document only the lines beyond that are deleted.
    """

    slim = docs.select(F.col(id_col).alias("id"), text_hash(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text"))
    names = ["fp", "at", "high", "low", "start", "end"]

    def of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_portions(batch.column("text")):
                found = [windows(text, min_words) for text in texts]
                owner = pa.array(first + np.repeat(np.arange(len(found)), [len(w) for w in found]))
                table = np.array([row for w in found for row in w], np.int64).reshape(-1, len(names))
                columns = [batch.column("id").take(owner), batch.column("text_hash").take(owner)]
                columns += [pa.array(table[:, i].astype(np.int64 if name in ("fp", "high", "low") else np.int32)) for i, name in enumerate(names)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "text_hash", *names])

    key_type = slim.schema["id"].dataType.simpleString()
    schema = f"id {key_type}, text_hash long, fp long, at int, high long, low long, start int, end int"
    found = written(slim.mapInArrow(of_texts, schema))
    # A fingerprint that stands in one place only cannot belong to a repeated window. Windows of
    # one place share it, so places are what is counted: the same line of the same text.
    # Joins are merge joins at every size, with a shuffle on both sides, so that hot keys can be split.
    place = F.xxhash64("text_hash", F.col("id").isNull(), "id", "at")
    often = written(
        found.groupBy("fp").agg(F.min(place).alias("a"), F.max(place).alias("z")).filter("a != z").select("fp")
    )
    shared = written(found.join(often.hint("merge"), "fp", "left_semi").drop("fp", "at"))
    order = F.struct(F.col("id").isNull().alias("unnamed"), "id", "text_hash", "start", "end")
    firsts = shared.groupBy("high", "low").agg(F.min(order).alias("first"), F.max(order).alias("last"))
    firsts = written(firsts.filter("first != last").drop("last"))
    later = shared.join(firsts.hint("merge"), ["high", "low"]).withColumn("order", order).filter("order > first")
    same = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("text_hash") == F.col("first.text_hash"))
    begin = F.when(same, F.greatest("start", F.col("first.end") + 1)).otherwise(F.col("start"))
    ranges = later.select("id", "text_hash", begin.alias("start"), "end").filter("start <= end")
    # Distinct first: rows that repeat a document would repeat its ranges.
    return ranges.distinct().groupBy("id", "text_hash").agg(F.collect_list(F.struct("start", "end")).alias("runs"))


_WORD = re.compile("[^\x20\x09-\x0d]+")


def without_repeats(text: str, runs, passages, gram: int = GRAM) -> tuple[str, int, bool]:
    """The text without the lines of the runs and the words of the passages, the number of lines gone,
    and whether any word is left.

    Blank lines go where the nearest other lines on both sides do; so does a line all of whose words go.
    """
    lines = text.split("\n")
    gone = [False] * len(lines)
    for run in runs if runs is not None else ():
        gone[run["start"] : run["end"] + 1] = [True] * (run["end"] + 1 - run["start"])
    if passages is not None:
        covered, at = gone_words(split_words(text), passages, gram), 0
        for number, line in enumerate(lines):
            size = len(split_words(line))
            cut = covered[at : at + size]
            at += size
            if size and all(cut):
                gone[number] = True
            elif any(cut) and not gone[number]:
                lines[number] = _without_words(line, cut)
    worded = [number for number, line in enumerate(lines) if gone[number] or line.split()]
    for before, after in zip(worded, worded[1:], strict=False):
        gone[before + 1 : after] = [gone[before] and gone[after]] * (after - before - 1)
    kept = [line for line, is_gone in zip(lines, gone, strict=True) if not is_gone]
    return "\n".join(kept), sum(gone), not all(gone[number] for number in worded)


def _cut_row(row: tuple[pa.Scalar, ...], gram: int) -> tuple[str | None, int, bool]:
    text, runs, passages = row
    return without_repeats(text.as_py(), runs.as_py(), passages.as_py(), gram) if text.is_valid else (None, 0, True)


def _without_words(line: str, cut: list[bool]) -> str:
    """What lies between the cut words, with one space for each cut."""
    pieces, start = [], None
    for match, is_cut in zip(_WORD.finditer(line), cut, strict=True):
        begin, end = match.span()
        if is_cut:
            start = None
        elif start is None:
            start = begin
            pieces.append(line[begin:end])
        else:
            pieces[-1] = line[start:end]
    return " ".join(pieces)


def dedup_lines(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    passage_words: int = MIN_PASSAGE,
    gram: int = GRAM,
) -> DataFrame:
    """All documents and columns, with ``deduped`` (text, deleted lines, whether words are left) added.

    The struct's column is called ``deduped`` unless the table has such a column already;
    then underscores precede it, and it is always the last column. Null and empty texts stay
    as they are, lines that only differ in outer blanks are equal, blank lines go where the lines
    on both sides go, words of a passage leave one space between what stays of their line. An empty table gives an empty table.
    """
    out = free_name(docs, "deduped")
    runs = repeated_runs(docs, min_words, id_col, text_col).withColumn("passages", F.lit(None))
    passages = repeated_passages(docs, passage_words, gram, id_col, text_col).withColumn("runs", F.lit(None))
    # Together in one table, so that texts are joined once.
    repeats = runs.unionByName(passages).groupBy(F.col("id").alias("run_id"), F.col("text_hash").alias("run_hash"))
    repeats = repeats.agg(F.first("runs", True).alias("runs"), F.first("passages", True).alias("passages"))
    # Whole rows in one column, so that no name of theirs can clash with those used here.
    marked = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    text = F.col("row").getField(text_col)
    marked = marked.withColumn("id", F.col("row").getField(id_col)).withColumn("hash", text_hash(text))
    joined = marked.join(repeats.hint("merge"), F.col("id").eqNullSafe(F.col("run_id")) & (F.col("hash") == F.col("run_hash")), "left")

    kept = pa.struct([("text", pa.string()), ("deleted", pa.int32()), ("left", pa.bool_())])

    @F.arrow_udf("text string, deleted int, left boolean")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array((_cut_row(row, gram) for row in zip(*batch, strict=True)), kept, size=len(batch[0]))

    # Only texts that change travel to Python.
    repeated = F.col("runs").isNotNull() | F.col("passages").isNotNull()
    cut_out = joined.withColumn("cut", cut(F.when(repeated, text), F.col("runs"), F.col("passages")))
    result = F.struct(F.coalesce("cut.text", text).alias("text"), F.col("cut.deleted").alias("deleted"), F.col("cut.left").alias("left"))
    return cut_out.select(*(F.col("row").getField(c).alias(c) for c in docs.columns), result.alias(out))


def drop_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with later repeats cut out of their texts; ``n_chars`` follows the text.

    A document of which nothing but blanks is left, so that all of it stands earlier, is dropped.
    Null and empty texts stay as they are, null ids and repeated rows are kept, an empty table
    gives an empty table, and further columns stay whatever their names.
    """
    found = dedup_lines(docs, min_words)
    result = found.columns[-1]
    text = F.col(f"{result}.text")
    columns = {"text": text, "n_chars": F.when(text != F.col("text"), F.length(text)).otherwise(F.col("n_chars")) if "n_chars" in docs.columns else None}
    return found.filter(F.col(f"{result}.left")).select(
        *(columns[c].alias(c) if columns.get(c) is not None else F.col(f"`{c}`") for c in docs.columns)
    )
