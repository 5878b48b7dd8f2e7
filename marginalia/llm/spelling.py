"""Grouping of spelling variants: words one edit apart, by dynamic programming over sorted lists.

Two words of which the longer has ``size`` characters part at some place; one edit apart, they agree
again behind it. So a word goes, for its own size and the next, into two lists: of the words that
agree with it outside the first half of the places, and outside the second half. Each pair of near
words meets in exactly one list, where only the middles, the part inside the half, still differ. A
list that gets too long is cut in two again by halving its places; at a single place a list holds no
more words than there are letters.

A list is sorted, and all its words are looked for in it at once. The band of the edit matrix is kept
for the prefix that a range of the list shares, so a row is worked out once for all words below it,
and a range whose prefix already differs by two edits is left with all it holds.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.batches import ragged, release
from marginalia.llm.tables import pick
from marginalia.scratch import Scratch

RUN = "[a-zÀ-ÿ]+"
#: Of so many occurrences of words one loses a character, by the checksum of its document and word.
ONE_IN = 97
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: A word's form is that many times as frequent as the word, at least.
TIMES = 2

#: Words in one list; longer lists are cut by their places.
LONGEST_LIST = 4_000

NO_LETTER = np.uint32(0xFFFFFFFF)
NEAR = "word string, n_near long, best_n long, best string"
PLACED = ("key", "size", "low", "high", "front", "back", "middle", "n")


# --- words ---------------------------------------------------------------------------------


def word_counts(documents: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``(word, n)``: runs of letters with ``A-Z`` in lower case, of which one in ``ONE_IN`` (by the
    checksum of ``<doc_id>:<run>``; a null id counts as empty) loses the character at that checksum's
    place. Null texts have no words."""
    rows = pick(documents, doc_id="doc_id", text="text")
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"))
    runs = rows.select(name.alias("name"), F.explode(F.regexp_extract_all(lower, F.lit(RUN), F.lit(0))).alias("run"))
    # Shorter runs give shorter words.
    summed = runs.filter(F.char_length("run") >= least_length).withColumn("h", F.crc32(F.concat("name", "run").cast("binary")))
    at = F.pmod("h", F.char_length("run").cast("long")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substr("run", at + 2))
    words = summed.select(F.when(F.col("h") % ONE_IN == 0, shorter).otherwise(F.col("run")).alias("word"))
    counts = words.filter(F.char_length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= least_count)


def _halves(rows: DataFrame) -> DataFrame:
    """Each row of ``(word, n, size, low, high)`` for both halves of its places."""
    cut = F.col("low") + F.floor((F.col("high") - F.col("low")) / 2).cast("int")
    halves = F.array(F.struct(F.col("low"), cut.alias("high")), F.struct(cut.alias("low"), F.col("high")))
    return rows.select("word", "n", "size", F.inline(halves)).filter("low < high")


def _placed(rows: DataFrame) -> DataFrame:
    """The rows with the parts of their word before, inside and behind their places, and the hash of
    their list."""
    behind = F.col("size") - F.col("high")
    end = F.char_length("word") - behind
    parts = rows.withColumns(
        {
            "front": F.substring("word", F.lit(1), F.col("low")),
            "middle": F.substring("word", F.col("low") + 1, end - F.col("low")),
            "back": F.substring("word", end + 1, behind),
        }
    )
    return parts.withColumn("key", F.xxhash64("size", "low", "high", "front", "back"))


def _lists(vocabulary: DataFrame, scratch: Scratch, longest: int) -> DataFrame:
    """The words in their lists, none of more than ``longest`` words but those of a single place.

    Only the words of lists that are too long are looked at in the next round. Lists that share a
    hash are counted together, and at worst cut once more than needed.
    """
    size = F.explode(F.array(F.char_length("word"), F.char_length("word") + 1))
    whole = vocabulary.select("word", "n", size.alias("size"))
    rows = _placed(_halves(whole.select("*", F.lit(0).alias("low"), F.col("size").alias("high"))))
    done = []
    while True:
        long = rows.filter("high - low > 1").groupBy("key").agg(F.count("*").alias("_n")).filter(F.col("_n") > longest)
        long = scratch.keep(long.select("key"), "long_lists")
        if long.isEmpty():
            break
        done.append(rows.join(long, "key", "left_anti").select(*PLACED))
        cut = _halves(rows.join(long, "key", "left_semi").select("word", "n", "size", "low", "high"))
        rows = _placed(scratch.keep(cut, "halves"))
    found = rows.select(*PLACED)
    for other in done:
        found = found.unionByName(other)
    return found


# --- lists ---------------------------------------------------------------------------------


def shared_prefixes(data: np.ndarray, start: np.ndarray, long: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many characters the words ``a`` and ``b`` (by number) begin alike with."""
    least = np.minimum(long[a], long[b])
    at = ragged(np.zeros(len(a), np.int64), least)
    differs = data[ragged(start[a], least)] != data[ragged(start[b], least)]
    found = least.copy()
    some = least > 0
    if some.any():
        found[some] = np.minimum.reduceat(np.where(differs, at, np.iinfo(np.int64).max), (np.cumsum(least) - least)[some])
    return np.minimum(found, least)


def one_edit_apart(data: np.ndarray, start: np.ndarray, long: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (word, other) at exactly one edit. The words are sorted, and word ``i`` is looked for
    in the list ``first[i] … end[i]`` it stands in.

    A state is a word with a range of its list, all of whose words begin with the same ``depth``
    characters, and the row of the edit matrix for these: what it costs to turn them into one
    character less of the word, as many, and one more. A step parts the range by the next character,
    where the common prefix of neighbours is no longer than ``depth``.
    """
    n = len(start)
    common = np.full(n, -1)
    inside = np.flatnonzero(first != np.arange(n))
    common[inside] = shared_prefixes(data, start, long, inside - 1, inside)
    word, low, high = np.arange(n), first, end
    less, same, more = (np.full(n, v, np.int8) for v in (2, 0, 1))
    more[long < 1] = 2
    words, others = [], []
    depth = 0

    def letter(of: np.ndarray, at: int) -> np.ndarray:
        if at < 0:
            return np.full(len(of), NO_LETTER)
        return np.where(at < long[of], data[np.minimum(start[of] + at, len(data) - 1)], NO_LETTER)

    while len(word):
        ends = long[low] == depth  # the first of a range is all prefix
        gap = long[word] - depth
        cost = np.select([gap == 0, gap == 1, gap == -1], [same, more, less], 2)
        met = ends & (cost == 1)
        words.append(word[met])
        others.append(low[met])
        parts = np.flatnonzero(common <= depth)
        from_part = np.searchsorted(parts, low + ends)
        count = np.maximum(np.searchsorted(parts, high) - from_part, 0)
        of, part = np.repeat(np.arange(len(word)), count), ragged(from_part, count)
        low, high = parts[part], np.r_[parts, n][part + 1]
        word = word[of]
        alone = (high - low == 1) & (low == word)
        of, low, high, word = of[~alone], low[~alone], high[~alone], word[~alone]
        if not len(word):
            break
        new = data[start[low] + depth]
        room = long[word] - depth
        next_less = np.minimum(less[of] + (letter(word, depth - 1) != new), same[of] + 1)
        next_same = np.minimum(np.minimum(same[of] + (letter(word, depth) != new), more[of] + 1), next_less + 1)
        next_same = np.where(room >= 1, next_same, 2)
        next_more = np.where(room >= 2, np.minimum(more[of] + (letter(word, depth + 1) != new), next_same + 1), 2)
        next_less = np.where(room >= 0, next_less, 2)
        alive = (next_less <= 1) | (next_same <= 1) | (next_more <= 1)
        word, low, high = word[alive], low[alive], high[alive]
        less, same, more = (v[alive].astype(np.int8) for v in (next_less, next_same, next_more))
        depth += 1
    return np.concatenate(words), np.concatenate(others)


def _letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The code points of all strings one after the other, and where each starts and how long it is."""
    long = pc.utf8_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    data = np.frombuffer("".join(column.to_pylist()).encode("utf-32-le"), np.uint32)
    return data, np.cumsum(long) - long, long


def _best_near(rows: pa.RecordBatch, new: np.ndarray) -> pa.RecordBatch:
    """``NEAR`` of the words of whole lists; ``new`` marks the first of each list."""
    data, start, long = _letters(rows.column("middle"))
    lists = np.flatnonzero(new)
    of = np.cumsum(new) - 1
    word, other = one_edit_apart(data, start, long, lists[of], np.r_[lists, len(new)][of + 1])
    places = (rows.column("high").to_numpy() - rows.column("low").to_numpy()).astype(np.int64)
    whole = long == places
    # A word that is one shorter than the list's size has near words of its size in another list.
    good = whole[word] | whole[other]
    # Where the shorter middle begins the longer, which ends as the back begins, they part behind.
    back, back_start, back_long = _letters(rows.column("back"))
    uneven = np.flatnonzero(good & (long[word] != long[other]) & (back_long[word] > 0))
    longer = np.where(whole[word], word, other)[uneven]
    shorter = np.where(whole[word], other, word)[uneven]
    late = data[start[longer] + long[longer] - 1] == back[back_start[longer]]
    uneven, longer, shorter = uneven[late], longer[late], shorter[late]
    good[uneven[shared_prefixes(data, start, long, shorter, longer) == long[shorter]]] = False
    word, other = word[good], other[good]
    names = pc.binary_join_element_wise(rows.column("front"), rows.column("middle"), rows.column("back"), "")
    order_of = np.argsort(np.argsort(np.array(names.to_pylist(), object), kind="stable"), kind="stable")
    n = rows.column("n").to_numpy()
    order = np.lexsort((order_of[other], -n[other], word))
    word, other = word[order], other[order]
    firsts = np.flatnonzero(np.diff(word, prepend=-1))
    counts = np.diff(np.r_[firsts, len(word)])
    best = other[firsts]
    return pa.record_batch([names.take(pa.array(word[firsts])), pa.array(counts, pa.int64()), pa.array(n[best], pa.int64()), names.take(pa.array(best))], ["word", "n_near", "best_n", "best"])


def _starts(rows: pa.RecordBatch) -> np.ndarray:
    new = np.ones(rows.num_rows, bool)
    new[1:] = False
    for name in PLACED[:6]:
        column = rows.column(name)
        new[1:] |= pc.not_equal(column.slice(1), column.slice(0, rows.num_rows - 1)).to_numpy(zero_copy_only=False)
    return new


def _search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``NEAR`` from rows sorted by list and middle; what waits for its list to end is one list."""
    waiting = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if waiting is None else pa.Table.from_batches([waiting, batch]).combine_chunks().to_batches()[0]
        new = _starts(rows)
        last = int(np.flatnonzero(new)[-1])
        if last:
            yield _best_near(rows.slice(0, last), new[:last])
        waiting = rows.slice(last)
    if waiting is not None:
        yield _best_near(waiting, _starts(waiting))
    release()


# --- forms ---------------------------------------------------------------------------------


def near_words(vocabulary: DataFrame, scratch: Scratch, longest: int = LONGEST_LIST) -> DataFrame:
    """``(word, n_near, best_n, best)`` for words of ``vocabulary(word, n)`` that have near words: how
    many, and the most frequent one (of equals the first in code-point order)."""
    lists = _lists(vocabulary, scratch, longest).repartition("key").sortWithinPartitions(*PLACED[:7])
    found = lists.mapInArrow(_search, NEAR)
    first = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("first")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first).select("word", "n_near", (-F.col("first.less")).alias("best_n"), "first.best")


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``(word, root)`` from ``(word, root)`` with the next form as root: a word whose form has a form
    jumps there. A form is twice as frequent as its word, so there are few rounds."""
    links = scratch.keep(forms, "forms")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jumped = links.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        before, links = links, scratch.keep(jumped, "roots")
        scratch.drop(before)
        if links.filter("moved").isEmpty():
            return links.select("word", "root")
        links = scratch.keep(links.select("word", "root"), "roots")


def spelling_variants(vocabulary: DataFrame, scratch: Scratch, times: int = TIMES, longest: int = LONGEST_LIST) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` per row of ``vocabulary(word, n)`` (one row a word).

    A word's form is its most frequent near word, if that is ``times`` times as frequent as the word
    at least. The root is the last form on the way; a word without form is its own.
    """
    known = vocabulary.join(near_words(vocabulary, scratch, longest), "word", "left")
    formed = F.col("best_n") >= times * F.col("n")
    known = scratch.keep(
        known.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n")),
        "near_words",
    )
    roots = _roots(known.filter("form is not null").select("word", F.col("form").alias("root")), scratch)
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def document_spellings(documents: DataFrame, scratch: Scratch) -> DataFrame:
    """The spelling variants among the words of all documents.

    Null and empty texts have no words; repeated rows count again; an empty table has no row.
    """
    return spelling_variants(scratch.keep(word_counts(documents), "vocabulary"), scratch)
