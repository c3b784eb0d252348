r"""Phrase collocations from one FM-index per shard over word ids.

A task numbers the words of its texts, language by language, and closes a shard at ``SHARD_WORDS``. A
shard is one row and one row group, so however many a file or task has, they are held one at a time.
Word counts are summed over shards first; words below the least count cannot stand in a candidate and
become breaks, so every shard's text is over frequent words only. Its suffixes are sorted by their
first four words (two rounds of doubling), which fixes the Burrows-Wheeler transform that the shard
keeps: extending an interval to the left by a word is the LF mapping of its rows, and the rows
reached, seen forward, say what the extended phrase begins with.

Phrases of two words are enumerated for all intervals of one word at once, and their counts summed over
the shards in one shuffle, where a phrase has at most one row per shard. Only intervals whose phrase is
frequent over all shards are extended further, in one more pass to three and four words. A phrase is
named by the ids of what it is made of, two or three numbers whatever the words. Written tables are so
well compressed that Spark takes their rows for too few: joins of them are merges and never broadcast.

Null languages are ``und``; null, empty and blank texts have no words; repeated rows count again; a
language without candidates has no rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.batches import ROW_GROUPS, bound_batches, kept, release, rows_of

LEAST = 30
DEPTH = 4
KEPT = 2000
COVERED = (4, 5)  # 80 of 100
SHARD_WORDS = 3 << 19
OPEN_WORDS = 4 << 20
# A place in a shard, a shard of a task, and the task, in one number of 63 bits.
PLACE_BITS, PART_BITS = 30, 13
SALTS = 64
BREAKS = b".,;:!?\n\x0b\x0c\r"
FOLD = bytes(c + 32 if 65 <= c <= 90 else 46 if c in BREAKS else 32 if c == 9 else c for c in range(256))
SHARDS = "shard bigint, lang string, n_words bigint, words array<int>, vocabulary array<string>, counts array<bigint>"
PAIRS = "at bigint, a bigint, b bigint, n int"
LONGER = "a bigint, m bigint, b bigint, n int"


def words_of(text: bytes) -> list[bytes]:
    """The words of a text, with a ``.`` wherever a piece ends."""
    return text.translate(FOLD).replace(b".", b" . ").split()


def text_shards(docs: DataFrame, size: int = SHARD_WORDS, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Shards of numbered words (0: break) with their vocabulary and its counts."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, texts, words, made = {}, defaultdict(list), defaultdict(int), 0
        first = TaskContext.get().partitionId() << PART_BITS

        def close(langs):
            nonlocal made
            for lang in langs:
                ids = np.concatenate([*texts.pop(lang), [0]]).astype(np.int32)
                named = numbers.pop(lang)
                counts = np.bincount(ids, minlength=len(named))[1:]
                names = [w.decode() for w in named][1:]
                del words[lang]
                columns = [
                    pa.array([first + made]), pa.array([lang]), pa.array([int(counts.sum())]),
                    pa.array([ids], pa.list_(pa.int32())), pa.array([names], pa.list_(pa.string())),
                    pa.array([counts], pa.list_(pa.int64())),
                ]
                made += 1
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in SHARDS.split(", ")])

        for langs, contents in rows_of(batches):
            for lang, text in zip(langs.to_pylist(), contents, strict=True):
                found = words_of(text)
                if lang not in numbers:
                    numbers[lang] = defaultdict()
                    numbers[lang].default_factory = numbers[lang].__len__
                    numbers[lang][b"."]
                get = numbers[lang].__getitem__
                texts[lang] += [[0], np.fromiter(map(get, found), np.int32, len(found))]
                words[lang] += len(found)
                if words[lang] >= size:
                    yield from close([lang])
                elif sum(words.values()) >= OPEN_WORDS:
                    yield from close(list(texts))
        yield from close(list(texts))

    named = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
    )
    return named.mapInArrow(run, SHARDS)


def truncated_bwt(words: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """The word before each suffix, suffixes in the order of their first ``depth`` words."""
    rank, width = words.astype(np.int64), 1
    while width < depth:
        key = rank * (int(rank.max()) + 1) + np.roll(rank, -width)
        order = np.argsort(key)
        ordered = key[order]
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        width *= 2
    return np.roll(words, 1)[order]


class Index:
    """LF mapping and the intervals of one shard, level by level."""

    def __init__(self, bwt: np.ndarray):
        rows = np.argsort(bwt, kind="stable").astype(np.int32)
        self.lf = np.empty(len(bwt), np.int32)
        self.lf[rows] = np.arange(len(bwt), dtype=np.int32)
        #: The number of the interval that each row belongs to; 0: none that may be extended.
        self.interval = bwt[rows]

    def extend(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first part, last part, count) of the intervals one word longer, which become the level's.

        Parts are intervals of the level before. Row i and the row its LF mapping leads to hold the
        last and the first words of the same longer phrase.
        """
        before = self.interval[self.lf]
        rows = np.flatnonzero((before > 0) & (self.interval > 0)).astype(np.int32)
        width = int(self.interval.max(initial=0)) + 1
        keys = before[rows].astype(np.int64) * width + self.interval[rows]
        del before
        order = np.argsort(keys).astype(np.int32)
        keys, rows = keys[order], rows[order]
        del order
        cuts = np.flatnonzero(np.concatenate([keys[:1] == keys[:1], keys[1:] != keys[:-1]]))
        counts = np.diff(np.append(cuts, len(keys)))
        interval = np.zeros(len(self.lf), np.int32)
        interval[self.lf[rows]] = np.repeat(np.arange(1, len(cuts) + 1, dtype=np.int32), counts)
        self.interval = interval
        keys = keys[cuts]
        return keys // width, keys % width, counts

    def keep(self, numbers: np.ndarray) -> None:
        """Go on with the intervals of these numbers only; they keep their numbers."""
        alive = np.zeros(int(self.interval.max(initial=0)) + 1, bool)
        alive[numbers] = True
        self.interval[~alive[self.interval]] = 0


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(shard, places, ids, content) of every shard with places, from the rows of ``with_places``."""
    held = []
    for batch in batches:
        own = np.stack([batch.column(c).fill_null(0).to_numpy() for c in ("place", "id")])
        contents, begin = batch.column("content"), 0
        for at in np.flatnonzero(batch.column("place").is_null().to_numpy(zero_copy_only=False)).tolist():
            place, ids = np.concatenate([*held, own[:, begin:at]], axis=1)
            held, begin = [], at + 1
            if len(place):
                yield batch.column("shard")[at].as_py(), place, ids, contents[at].values.to_numpy()
        held.append(own[:, begin:])


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's BWT over its frequent words, renumbered, with their ids."""
    for shard, local, ids, words in _shards(batches):
        order = np.argsort(local)
        number = np.zeros(int(words.max(initial=0)) + 1, np.int32)
        number[local[order]] = np.arange(1, len(local) + 1)
        text = number[words]
        text = text[np.concatenate([[True], (text[1:] != 0) | (text[:-1] != 0)])]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([shard]), pa.array([truncated_bwt(text)], pa.list_(pa.int32())),
                pa.array([ids[order]], pa.list_(pa.int64())),
            ],
            ["shard", "bwt", "ids"],
        )


def _columns(names: list[str], *values: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Batches of so many rows of equally long columns."""
    for at in range(0, len(values[0]), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(v[at : at + (1 << 16)]) for v in values], names)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The phrases of two words of every shard, with their place in it."""
    for batch in batches:
        for i in range(batch.num_rows):
            index = Index(batch.column("bwt")[i].values.to_numpy())
            names = np.concatenate([[0], batch.column("ids")[i].values.to_numpy()])
            first, last, counts = index.extend()
            base = batch.column("shard")[i].as_py() << PLACE_BITS
            places = np.arange(base + 1, base + len(counts) + 1)
            yield from _columns(["at", "a", "b", "n"], places, names[first], names[last], counts.astype(np.int32))


def _longer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The phrases of three and four words of every shard whose pairs are all frequent, named by them."""
    for _, place, ids, bwt in _shards(batches):
        index = Index(bwt)
        index.extend()
        index.keep(place)
        names = np.zeros(int(place.max(initial=0)) + 1, np.int64)
        names[place] = ids
        first, last, counts = index.extend()
        begin, end = names[first], names[last]
        out = ["a", "m", "b", "n"]
        yield from _columns(out, begin, np.zeros(len(begin), np.int64), end, counts.astype(np.int32))
        front, back, counts = index.extend()
        yield from _columns(out, begin[front - 1], end[front - 1], end[back - 1], counts.astype(np.int32))


def mine(
    docs: DataFrame, least: int = LEAST, size: int = SHARD_WORDS, lang_col: str = "lang", text_col: str = "text"
) -> tuple[DataFrame, dict[int, DataFrame]]:
    """(lang, n) and, per number of words, the frequent phrases.

    Single words are (id, lang, words, f), longer phrases (id, a, b, f) with a and b the ids of what is
    left of them without their last and without their first word.
    """
    shards = kept(text_shards(docs, size, lang_col, text_col), "shards", **{ROW_GROUPS: 1})
    totals = shards.groupBy("lang").agg(F.sum("n_words").alias("n"))
    words = shards.select("lang", "shard", F.posexplode(F.arrays_zip("vocabulary", "counts")).alias("place", "w"))
    words = words.select(
        "lang", "shard", (F.col("place") + 1).alias("place"), F.col("w.vocabulary").alias("words"),
        F.col("w.counts").alias("n"),
    )
    sums = words.groupBy("lang", "words").agg(F.sum("n").alias("f")).filter(F.col("f") >= least)
    level = {1: numbered_densely(sums)}
    own = words.join(level[1].select("lang", "words", "id").hint("merge"), ["lang", "words"])
    index = kept(
        with_places(shards.select("shard", "words"), own).mapInArrow(
            _indexed, "shard bigint, bwt array<int>, ids array<bigint>"
        ),
        "bwt", **{ROW_GROUPS: 1},
    )
    totals = kept(totals, "totals")
    release(shards)
    by_phrase = Window.partitionBy("a", "b")
    counted = index.mapInArrow(_pairs, PAIRS).withColumn("f", F.sum("n").over(by_phrase)).filter(F.col("f") >= least)
    # Rows of one phrase lie in one task: the least of their numbers is the phrase's id.
    numbered = counted.withColumn("row", F.monotonically_increasing_id() + 1)
    named = numbered.withColumn("id", F.min("row").over(by_phrase))
    told = F.when(F.col("row") == F.col("id"), F.struct("a", "b", "f"))
    pairs = kept(named.select("at", "id", told.alias("told")), "pairs")
    level[2] = kept(pairs.filter("told IS NOT NULL").select("id", "told.*"), "pairs-once")
    own = pairs.select(
        F.shiftright("at", PLACE_BITS).alias("shard"),
        F.col("at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).alias("place"), "id",
    )
    alive = with_places(index.select("shard", "bwt"), own)
    sums = alive.mapInArrow(_longer, LONGER).groupBy("a", "m", "b").agg(F.sum("n").alias("f"))
    found = sums.filter(F.col("f") >= least).withColumn("id", F.monotonically_increasing_id() + 1)
    longer = kept(found, "longer")
    release(index, pairs)
    level[3] = longer.filter("m = 0").select("id", "a", "b", "f")
    # Four words are known by their pairs; their first and last three words are so, too.
    front = level[3].select(F.col("id").alias("front"), "a", F.col("b").alias("m"))
    back = level[3].select(F.col("id").alias("back"), F.col("a").alias("m"), "b")
    four = longer.filter("m <> 0").join(front.hint("merge"), ["a", "m"]).join(back.hint("merge"), ["m", "b"])
    level[4] = kept(four.select("id", F.col("front").alias("a"), F.col("back").alias("b"), "f"), "fours")
    return totals, level


def numbered_densely(rows: DataFrame) -> DataFrame:
    """``rows``, written, with ``id`` from 1 to their number: small numbers move in few bytes."""
    low = (1 << 33) - 1  # of a row's number within its task
    row = F.monotonically_increasing_id()
    held = kept(rows.withColumns({"part": F.shiftright(row, 33), "row": row.bitwiseAND(F.lit(low))}), "words")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A row per task.
    sizes = held.groupBy("part").agg(F.count("*").alias("n"))
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return kept(held.join(starts, "part").withColumn("id", F.col("start") + F.col("row") + 1).drop("part", "row", "start"), "words")


def with_places(contents: DataFrame, own: DataFrame) -> DataFrame:
    """(shard, place, id, content): in one task the places and ids alive in a shard, a row each, then its content.

    A place has an empty list, the content no place: a null in a list's column costs Arrow's writer far more.
    """
    nothing = F.lit(None).cast("bigint")
    held = contents.toDF("shard", "content").select("shard", nothing.alias("place"), nothing.alias("id"), "content")
    told = own.select("shard", F.col("place").cast("bigint"), "id", F.array().cast("array<int>").alias("content"))
    # One number to sort by needs no comparison of rows.
    order = F.col("shard") * 2 + F.col("place").isNull().cast("int")
    return told.unionByName(held).repartition("shard").sortWithinPartitions(order)


def spelled(level: dict[int, DataFrame]) -> dict[int, DataFrame]:
    """Phrases with their words and the counts of all their beginnings and ends, shortest first."""
    counts = F.array("f")
    told = {1: level[1].select("id", "lang", F.col("words").alias("phrase"), F.col("words").alias("last"), "f",
                               counts.alias("heads"), counts.alias("tails"))}
    for n in range(2, DEPTH + 1):
        begin = told[n - 1].select(F.col("id").alias("a"), "lang", "phrase", "heads")
        end = told[n - 1].select(F.col("id").alias("b"), "last", "tails")
        longer = level[n].join(begin.hint("merge"), "a").join(end.hint("merge"), "b").select(
            "id", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", "f",
            F.concat("heads", counts).alias("heads"), F.concat("tails", counts).alias("tails"),
        )
        # The next level reads it twice.
        told[n] = kept(longer, f"spelled-{n}") if n < DEPTH else longer
    return told


def candidates(level: dict[int, DataFrame]) -> DataFrame:
    """Phrases of two words or more with their lowest cut and their most frequent extensions.

    (lang, phrase, a, score, k, l, r, left, right): ``left`` and ``right`` are the greatest counts among
    phrases one word longer at that end, null where there is none.
    """
    found = []
    for n, phrases in spelled(level).items():
        if n == 1:
            continue
        wide = "cast({} as decimal(20, 0))".format
        cuts = []
        for k in range(1, n):
            first, rest = f"heads[{k - 1}]", f"tails[{n - k - 1}]"
            score = F.expr(f"({wide('f')} * 2000000BD) div ({wide(first)} + {wide(rest)})")
            cuts.append(F.struct(
                score.alias("score"), F.lit(k).alias("k"), F.expr(first).alias("l"), F.expr(rest).alias("r")
            ))
        cut = F.least(*cuts) if len(cuts) > 1 else cuts[0]
        row = phrases.select("id", "lang", "phrase", F.col("f").alias("a"), cut.alias("c"))
        for side, part in (("right", "a"), ("left", "b")):
            if n < DEPTH:
                longer = level[n + 1].groupBy(F.col(part).alias("id")).agg(F.max("f").alias(side))
                row = row.join(longer.hint("merge"), "id", "left")
            else:
                row = row.withColumn(side, F.lit(None).cast("bigint"))
        found.append(row.select("lang", "phrase", "a", "c.*", "left", "right"))
    return found[0].unionByName(found[1]).unionByName(found[2])


def collocations(docs: DataFrame, top: int = KEPT, **options) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of every language.

    A phrase goes if a longer one that contains it is nearly as frequent. Counts never grow with the
    length, so it is enough to look at phrases one word longer.
    """
    totals, level = mine(docs, **options)
    part, whole = COVERED
    longest = F.greatest(F.coalesce("left", F.lit(0)), F.coalesce("right", F.lit(0)))
    open_ones = candidates(level).filter(longest * whole < F.col("a") * part)
    best = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    # A language may hold nearly all phrases: first the best of every salt, then of those.
    some = open_ones.withColumn("salt", salt)
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best)))
    some = some.filter(F.col("rank") <= top).drop("rank", "salt")
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)))
    return ranked.filter(F.col("rank") <= top).join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
