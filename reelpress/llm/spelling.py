"""Spelling variant grouping by a relational trie frontier.

All words stand in a trie whose nodes are prefixes, as a table: one row per node with its children, at
most one per letter. A word's search is a set of states (word, position, node, edits), joined with the
table level by level. States without an edit are the word's own prefixes; at each of them the word may
replace its letter by another child's or leave it out, and the state goes on with one edit as long
as the word's letters lead to children. A state that has used up its word at a node that is a word
has found a neighbour. Inserting a letter is the other word's leaving it out, so both directions of a
found pair count.

One edit lies in the first or the second half of a word. So words are searched twice, as written and
reversed, each time with edits in the second half only: the frontier starts where the trie no longer fans
out, instead of at the root, where every word would visit every branch. A child is told with
two masks, of the letters that follow below it and of the lengths of what is left of its words, so a state that
dies at the next level is mostly never written. A level is one join; the side of the trie has one
row per node, so a node that a third of all words share can be split on the side of states.

Words of more than ``LEVELS`` letters would need as many joins. They meet by hashes instead: the parts
before and after each letter, and before and after each gap, with its position. Words that differ in that letter share
the key with at most the alphabet's number of words; found pairs are compared exactly.

Defined results: null texts have no words; a null doc_id counts as an empty id; repeated rows count again;
equal counts of neighbours go to the smaller word; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from uuid import uuid4

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelpress.llm.common import text_of
from reelpress.session import shared_folder, use_checkpoints

#: Letters: ASCII ones and the code points of Latin-1 from 192.
RUN = "[A-Za-zÀ-ÿ]+"
#: Words of more letters than this meet by hashes.
LEVELS = 40
#: Distinct words counted in a task before they are given out.
COUNTED = 100_000
#: Characters of a text that are searched for words at a time.
PORTION = 1 << 20


def runs(text: str, find=re.compile(RUN), inside=re.compile("[^A-Za-zÀ-ÿ]")) -> Iterator[list[str]]:
    """All runs of letters, A-Z lower-cased, a bounded portion of the text at a time."""
    at = 0
    while at < len(text):
        end = inside.search(text, at + PORTION) if at + PORTION < len(text) else None
        upto = end.start() if end else len(text)
        yield find.findall(text[at:upto].encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))
        at = upto


def _counts(min_length: int, every: int):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for doc, text in batch.itertuples(index=False):
                start = zlib.crc32(f"{doc}:".encode())
                for found in runs(text):
                    for run, n in Counter(found).items():
                        code = zlib.crc32(run.encode(), start)
                        if code % every == 0:
                            at = code % len(run)
                            run = run[:at] + run[at + 1 :]
                        if len(run) >= min_length:
                            seen[run] += n
                if len(seen) >= COUNTED:
                    yield _frame(seen)
                    seen.clear()
        yield _frame(seen)

    return count


def _frame(seen: Counter[str]) -> pd.DataFrame:
    return pd.DataFrame(
        {"word": pd.Series(list(seen), dtype=object), "n": pd.Series(list(seen.values()), dtype="int64")}
    )


def word_counts(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    min_length: int = 7,
    min_count: int = 2,
    every: int = 31,
) -> DataFrame:
    """(word, n) of the words of all texts; one in ``every`` (document, run) pairs loses a letter.

    Which pair loses which letter is told by the crc32 of ``doc_id:run``.
    """
    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("doc"), text_of(text).alias("text"))
    return (
        rows.mapInPandas(_counts(min_length, every), "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= min_count)
    )


def _letter(word: Column | str, at: Column) -> Column:
    """The letter at a place from 0; empty beyond the end."""
    return F.substring(word, at + 1, F.lit(1))


def _bit(number: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (number % 64).cast("int"))


def _trie(forms: DataFrame) -> DataFrame:
    """Node rows: back, depth, node, n (of the word that ends here) and children (ch, n, next, ends)."""
    # a word of one letter more, or as many, comes here at half its own length at the earliest
    paths = forms.withColumn("depth", F.explode(F.sequence(F.expr("start - 1"), F.col("size"))))
    left = F.col("size") - F.col("depth") - 1
    return (
        paths.groupBy(
            "back",
            "depth",
            F.substring("form", F.lit(1), F.col("depth")).alias("node"),
            _letter("form", F.col("depth")).alias("ch"),
        )
        .agg(
            F.max(F.when(left <= 0, F.col("n"))).alias("n"),
            F.bit_or(F.when(left > 0, _bit(F.ascii(_letter("form", F.col("depth") + 1)))).otherwise(0)).alias("next"),
            F.bit_or(F.when(left > 0, _bit(left)).otherwise(0)).alias("ends"),
        )
        .groupBy("back", "depth", "node")
        .agg(
            F.max(F.when(F.col("ch") == "", F.col("n"))).alias("own"),
            F.collect_list(F.when(F.col("ch") != "", F.struct("ch", "n", "next", "ends"))).alias("children"),
        )
    )


def _step(states: DataFrame, level: DataFrame, depth: int) -> DataFrame:
    """States one level on; ``found`` is the count of the word where one is complete."""
    met = states.join(level, ["back", "node"])
    form, size, at = F.col("form"), F.col("size"), F.col("at")

    def onward(child: Column, place: Column) -> Column:
        """Whether the letters from ``place`` on may lead on below the child, or it ends the word."""
        left = size - place
        return F.when(left == 0, child["n"].isNotNull()).otherwise(
            (child["next"].bitwiseAND(_bit(F.ascii(_letter(form, place)))) != 0)
            & (child["ends"].bitwiseAND(_bit(left)) != 0)
        )

    def moves(chosen, place: Column) -> Column:
        return F.transform(
            F.filter("children", lambda c: chosen(c) & onward(c, place)),
            lambda c: F.struct(
                place.alias("at"),
                F.concat("node", c["ch"]).alias("node"),
                F.when(size == place, c["n"]).alias("found"),
            ),
        )

    match = moves(lambda c: c["ch"] == _letter(form, at), at + 1)
    replace = moves(lambda c: c["ch"] != _letter(form, at), at + 1)
    leave_out = F.when(
        size == at + 1,
        F.when(
            F.col("own").isNotNull(),
            F.array(F.struct(size.alias("at"), F.col("node"), F.col("own").alias("found"))),
        ).otherwise(F.array()),
    ).otherwise(moves(lambda c: c["ch"] == _letter(form, at + 1), at + 2))
    made = F.when(F.col("edits") == 1, match).otherwise(F.concat(replace, leave_out))
    return met.select("back", "form", "n", "size", F.lit(1).alias("edits"), F.inline(made))


def _by_trie(words: DataFrame, min_length: int) -> DataFrame:
    """(word, n, near, near_n), at least one direction of each pair of words of up to LEVELS letters."""
    spark = words.sparkSession
    folder = f"{shared_folder(spark)}/spelling-{uuid4().hex}"
    size = F.length("word")
    forms = (
        words.withColumn("back", F.explode(F.array(F.lit(False), F.lit(True))))
        .select(
            "back",
            F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word")).alias("form"),
            "n",
            size.alias("size"),
            F.when(F.col("back"), F.ceil(size / 2)).otherwise(F.floor(size / 2)).cast("int").alias("start"),
        )
    )
    forms.write.parquet(f"{folder}/forms")
    forms = spark.read.parquet(f"{folder}/forms")
    longest = forms.agg(F.max("size")).first()[0]
    if longest is None:
        return words.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n")).where("false")
    _trie(forms).write.partitionBy("depth").parquet(f"{folder}/trie")
    trie = spark.read.schema(
        "back boolean, node string, own long, children array<struct<ch string, n long, next long, ends long>>, depth int"
    ).parquet(f"{folder}/trie")
    frontier, found = None, []
    for depth in range(min_length // 2, longest):
        here = forms.where((F.col("start") <= depth) & (F.col("size") > depth)).select(
            "back", "form", "n", "size", F.lit(0).alias("edits"), F.lit(depth).alias("at"),
            F.substring("form", 1, depth).alias("node"),
        )
        if frontier is not None:
            here = here.unionByName(frontier)
        level = trie.where(F.col("depth") == depth).drop("depth")
        path = f"{folder}/level-{depth}"
        stepped = _step(here, level, depth)
        stepped.write.parquet(path)
        stepped = spark.read.schema(stepped.schema).parquet(path)
        found.append(stepped.where("found IS NOT NULL"))
        frontier = stepped.where("found IS NULL").drop("found")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    plain = lambda c: F.when(F.col("back"), F.reverse(c)).otherwise(F.col(c))
    return every.select(plain("form").alias("word"), "n", plain("node").alias("near"), F.col("found").alias("near_n"))


def _parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Keys of long words: position and hashes of what lies before and after a letter, or a gap."""
    for batch in batches:
        for word in batch["word"]:
            before, after = _digests(word), _digests(word[::-1])[::-1]
            for at in range(0, len(word) + 1, 50_000):
                places = range(at, min(at + 50_000, len(word) + 1))
                rows = [(p, before[p], after[p], True) for p in places]
                rows += [(p, before[p], after[p + 1], False) for p in places if p < len(word)]
                frame = pd.DataFrame(rows, columns=["place", "before", "after", "whole"])
                frame.insert(0, "id", before[-1])
                yield frame


def _digests(word: str) -> list[str]:
    """128-bit hashes of all prefixes, in linear work."""
    state, made = xxhash.xxh3_128(), []
    for letter in ("", *word):
        state.update(letter.encode())
        made.append(state.hexdigest())
    return made


def _by_parts(words: DataFrame) -> DataFrame:
    """Pairs of long words as ``_by_trie`` gives them; only hashes meet, words join the found pairs."""
    keys = words.select("word").mapInPandas(
        _parts, "id string, place long, before string, after string, whole boolean"
    )
    other = keys.select("place", "before", "after", F.col("id").alias("near_id"))
    pairs = (
        keys.where("NOT whole")
        .join(other, ["place", "before", "after"])
        .where("id != near_id")
        .select("id", "near_id")
        .distinct()
    )

    @F.pandas_udf("string")
    def digest(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(lambda word: xxhash.xxh3_128(word.encode()).hexdigest())

    named = words.withColumn("id", digest("word"))
    near = named.select(F.col("id").alias("near_id"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return (
        pairs.join(named, "id")
        .join(near, "near_id")
        .where(F.levenshtein("word", "near", 1) == 1)
        .select("word", "n", "near", "near_n")
    )


def neighbours(words: DataFrame, min_length: int) -> DataFrame:
    """(word, near, near_n) of all words one edit apart, both directions, once each."""
    short = words.where(F.length("word") <= LEVELS)
    long = words.where(F.length("word") >= LEVELS)  # those of LEVELS letters are near to longer ones
    pairs = _by_trie(short, min_length).unionByName(_by_parts(long))
    both = pairs.select("word", "near", "near_n").unionByName(
        pairs.select(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    )
    return both.distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) by pointer doubling; counts grow tenfold at each form, so paths are short."""
    state = forms.select("word", F.col("form").alias("root")).checkpoint()
    while True:
        above = state.select(F.col("word").alias("root"), F.col("root").alias("up"))
        state = state.join(above, "root", "left").select(
            "word", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved")
        ).checkpoint()
        if state.where("moved").isEmpty():
            return state.drop("moved")
        state = state.drop("moved")


def spelling_forms(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    min_length: int = 7,
    min_count: int = 2,
    ratio: int = 10,
    every: int = 31,
) -> DataFrame:
    """One row per word: n, n_near, form, form_n and root."""
    spark = docs.sparkSession
    use_checkpoints(spark)
    path = f"{shared_folder(spark)}/spelling-words-{uuid4().hex}"
    word_counts(docs, text, doc_id, min_length, min_count, every).write.parquet(path)
    words = spark.read.parquet(path)
    best = F.min(F.struct((-F.col("near_n")).alias("of"), "near")).alias("best")
    near = neighbours(words, min_length).groupBy("word").agg(F.count("*").alias("n_near"), best)
    told = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.of") >= ratio * F.col("n"), F.struct(F.col("best.near").alias("form"), (-F.col("best.of")).alias("n"))).alias("to"),
    ).checkpoint()
    formed = told.where("to IS NOT NULL").select("word", F.col("to.form").alias("form"))
    return told.join(_roots(formed), "word", "left").select(
        "word",
        F.col("to.form").alias("form"),
        F.coalesce("root", "word").alias("root"),
        "n",
        "n_near",
        F.col("to.n").alias("form_n"),
    )
