"""Words one letter apart, by pairs of trie nodes.

The words form a trie, read forward, and another, read backward; the nodes of both are
numbered. A word passes the prefix node of every position and the suffix node of every
position, so each place of it is a pair of whole numbers: with the letter there skipped, or
with no letter skipped. Words that skip one letter to the same pair differ in that letter;
a word that skips a letter to the pair of another that skips none has that letter more.
At most one word of each letter of the alphabet meets in a pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from airway.sources.staging import Work, session_work

# Fixed values of the contract: letters, the share of runs that lose one, the least word.
LETTERS = r"[A-Za-zÀ-ÿ]+"
EVERY, LEAST_LENGTH, LEAST_COUNT, TIMES = 199, 6, 5, 5

# Trie nodes up to this depth are so few (1 + 90 + 90 * 90, A-Z being lowered) that their numbers are
# broadcast; they are the ones that most words pass.
SHALLOW = 2
_ROWS = 20_000


def word_counts(docs: DataFrame, id_column: str, text: str, least_length: int, least_count: int) -> DataFrame:
    """``word, n``: runs of letters, A-Z lowered. A run whose checksum with the document's id
    ``EVERY`` divides loses the code point that the checksum names."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    runs = F.regexp_extract_all(F.translate(text, upper, lower), F.lit(LETTERS), F.lit(0))
    name = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    rows = docs.select(name.alias("name"), F.explode(runs).alias("run")).where(F.length("run") >= least_length)
    rows = rows.withColumn("h", F.crc32(F.concat("name", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = rows.select(F.when(F.col("h") % EVERY == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def by_preference(words: DataFrame, work: Work) -> DataFrame:
    """``word, n, id``, staged: ids ascend from the most frequent word down, equal counts by
    code points, so the least id of some words is the one preferred."""
    order = [F.desc("n"), F.asc("word")]
    rows = words.repartitionByRange(*order).sortWithinPartitions(*order)
    return work.stage(rows.withColumn("id", F.monotonically_increasing_id()), "words")


_PLACE = "id long, skips boolean, last boolean, before binary, before_depth int, after binary, after_depth int"


def places(words: DataFrame) -> DataFrame:
    """Every place of every word. ``before`` and ``after`` name the trie nodes by a 128-bit
    digest of their path, made letter by letter, so a word costs its length. ``last``: the
    skipped letter is not followed by itself; skipping any of a run of one letter gives the
    same word, and the last of the run stands for it."""
    shape = StructType.fromDDL(_PLACE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = to_arrow_schema(shape)

        def nodes(letters) -> Iterator[bytes]:
            path = blake2b(digest_size=16)
            yield path.digest()
            for letter in letters:
                path.update(letter.encode("utf-8", "surrogatepass"))
                yield path.digest()

        def rows(i: int, word: str) -> Iterator[tuple]:
            size = len(word)
            ends = b"".join(nodes(reversed(word)))
            for k, before in enumerate(nodes(word)):
                left = size - k
                yield i, False, False, before, k, ends[16 * left : 16 * left + 16], left
                if left:
                    last = left == 1 or word[k] != word[k + 1]
                    yield i, True, last, before, k, ends[16 * left - 16 : 16 * left], left - 1

        held: list[tuple] = []
        for batch in batches:
            for i, word in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for row in rows(i, word):
                    held.append(row)
                    if len(held) == _ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), kinds)], schema=kinds)
                        held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), kinds)], schema=kinds)

    return words.select("id", "word").mapInArrow(run, shape)


def with_numbers(rows: DataFrame, node: str, work: Work) -> DataFrame:
    """``rows`` with the number of the trie node instead of its name. Numbers of shallow nodes
    are broadcast and not shuffled, so the beginnings that most words share are no hot keys."""
    depth = f"{node}_depth"
    known = work.stage(rows.select(F.col(node).alias("name"), F.col(depth).alias("depth")).distinct()
                       .withColumn("number", F.monotonically_increasing_id()), f"trie-{node}")
    few = known.where(F.col("depth") <= SHALLOW).select(F.col("name").alias(node), F.col("number").alias("near"))
    rest = known.where(F.col("depth") > SHALLOW).select(F.col("name").alias("deep"), "number")
    rows = rows.join(F.broadcast(few), node, "left")
    # A shallow row asks for a name that no node has, one for each word.
    rows = rows.withColumn("deep", F.when(F.col("near").isNull(), F.col(node)).otherwise(F.col("id").cast("string").cast("binary")))
    return rows.join(rest, "deep", "left").withColumn(node, F.coalesce("near", "number")).drop(depth, "deep", "near", "number")


def near_words(pairs: DataFrame) -> DataFrame:
    """``id, n_near, best`` of words that are near another; ``best`` is their least id.
    The words of a pair are no more than the letters and one."""
    member = F.struct("id", "skips", "last")
    met = pairs.groupBy("before", "after").agg(F.sort_array(F.collect_list(member)).alias("met")).where(F.size("met") > 1)

    def ids(some: Column) -> Column:
        return F.transform(some, lambda x: x["id"])

    # Who skips differs in the letter skipped. Who skips a last letter has it more than who skips none.
    skip = ids(F.filter("met", lambda x: x["skips"]))
    longer = ids(F.filter("met", lambda x: x["last"]))
    shorter = ids(F.filter("met", lambda x: ~x["skips"]))
    each = met.select(F.explode("met").alias("own"), skip.alias("skip"), longer.alias("longer"), shorter.alias("shorter"))
    none = F.array().cast("array<long>")
    others = (
        F.when(~F.col("own.skips"), F.col("longer"))
        .when(F.col("own.last"), F.concat("skip", "shorter"))
        .otherwise(F.col("skip"))
    )
    found = F.filter(F.coalesce(others, none), lambda x: x != F.col("own.id"))
    rows = each.select(F.col("own.id").alias("id"), found.alias("found")).where(F.size("found") > 0)
    return rows.groupBy("id").agg(F.sum(F.size("found")).alias("n_near"), F.min(F.array_min("found")).alias("best"))


def ends_of(links: DataFrame, work: Work) -> DataFrame:
    """``id, to`` with each ``to`` replaced by the last of its chain; every round doubles
    the way, and counts fall along a chain, so there are no circles."""
    links = work.stage(links, "links")
    while True:
        onward = links.select(F.col("id").alias("to"), F.col("to").alias("then"))
        moved = work.stage(links.join(onward, "to", "left").select("id", F.coalesce("then", "to").alias("to"), "then"), "links")
        links = moved.select("id", "to")
        if moved.where("then IS NOT NULL").isEmpty():
            return links


def spelling_variants(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    times: int = TIMES,
    work: Work | None = None,
) -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``; runs jobs.

    Words are those of at least ``least_length`` code points that occur ``least_count`` times
    in all texts. Near words differ by one inserted, deleted or replaced code point. The form
    is the near word of largest ``n`` (ties: least in code-point order) if it occurs ``times``
    times as often; ``times`` must be above 1. The root ends the chain of forms. Null and empty
    texts have no words; without id a row counts with an empty id. Repeated rows count again,
    long texts and words are read whole, an empty table gives no rows. Other columns are not
    read."""
    if times <= 1:
        raise ValueError("times must be above 1, or forms could go in circles")
    work = work or session_work(docs.sparkSession)
    words = by_preference(word_counts(docs, id_column, text, least_length, least_count), work)
    pairs = with_numbers(with_numbers(work.stage(places(words), "places"), "before", work), "after", work)
    near = work.stage(near_words(pairs), "near")
    best = words.select(F.col("id").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    known = words.join(near, "id", "left").join(best, "best", "left")
    has = F.col("form_n") >= times * F.col("n")
    known = work.stage(
        known.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                     *[F.when(has, F.col(c)).alias(c) for c in ("best", "form", "form_n")]), "known")
    ends = ends_of(known.where("best IS NOT NULL").select("id", F.col("best").alias("to")), work)
    roots = ends.join(words.select(F.col("id").alias("to"), F.col("word").alias("root")), "to").select("id", "root")
    found = known.join(roots, "id", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
