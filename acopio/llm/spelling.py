"""Spelling variants: words one letter apart, found by pairs of trie nodes.

A word cut at position i is a node of the trie of all words (the letters before i) and a node
of the trie of all reversed words (the letters from i on). Both tries are numbered, so a word
with one position skipped is a pair of integers, and so is a word cut between two letters:

* two words with the same skipped pair differ in that one letter;
* a word whose cut pair is another word's skipped pair lacks that one letter.

Integer pairs are equal exactly when the letters are, so nothing is verified afterwards.
A pair has at most one word per letter of the alphabet, which bounds every group.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acopio.session import stage

#: A letter of a word, after A-Z were lower-cased.
LETTERS = "[a-zÀ-ÿ]+"
#: Nodes this deep or less are numbered by their letters, one byte each; words are dealt to tasks by them.
HEAD = 7
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPLIT, _SKIP, _SKIP_FIRST = 0, 1, 2


def runs(text: Column) -> Column:
    """The maximal runs of letters of a text, A-Z lower-cased; none for a null text."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(LETTERS), F.lit(0))


def _numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Nodes of words that come in order: a word shares the nodes of the prefix it has in common with the word before."""
    deep = (TaskContext.get().partitionId() + 1) << 40
    last, path = b"", [0]
    for batch in batches:
        paths = []
        for letters in batch["letters"]:
            word = letters.encode("latin-1")
            same, most = 0, min(len(last), len(word))
            while same < most and last[same] == word[same]:
                same += 1
            path = path[: same + 1]
            for i in range(same, len(word)):
                if i < HEAD:
                    path.append(path[-1] << 8 | word[i])
                else:
                    deep += 1
                    path.append(-deep)
            last = word
            paths.append(path)
        yield pd.DataFrame({"id": batch["id"], "nodes": paths})


def trie_nodes(words: DataFrame, letters: Column) -> DataFrame:
    """(id, nodes) of words (id, word): the number of each prefix of ``letters``, shortest first.

    All words with the same first letters are in one task and in order, so every prefix has one
    number; numbers do not depend on the attempt of a task. Memory is that of one path.
    """
    rows = words.select("id", letters.alias("letters"))
    dealt = rows.repartition(F.substring("letters", 1, HEAD)).sortWithinPartitions("letters")
    return dealt.mapInPandas(_numbered, "id long, nodes array<long>")


def _pairs(words: DataFrame) -> DataFrame:
    """(p, s, kind, less, id): a row for each letter skipped and for each place between letters.

    ``less`` is the negative count of the word. ``kind`` tells cuts, skips, and skips of the
    first letter of a run of equal ones apart: skipping any letter of a run gives the same word.
    """
    front = trie_nodes(words, F.col("word")).withColumnRenamed("nodes", "front")
    back = trie_nodes(words, F.reverse("word")).select("id", F.reverse("nodes").alias("back"))
    both = words.withColumn("chars", F.array_remove(F.split("word", ""), "")).drop("word").join(front, "id").join(back, "id")

    def at(i: Column) -> Column:
        first = F.when(i == 0, True).otherwise(F.get("chars", i) != F.get("chars", i - 1))
        skip = F.struct(
            F.get("front", i).alias("p"), F.get("back", i + 1).alias("s"), F.when(first, _SKIP_FIRST).otherwise(_SKIP).alias("kind")
        )
        cut = F.struct(F.get("front", i).alias("p"), F.get("back", i).alias("s"), F.lit(_SPLIT).alias("kind"))
        return F.when(i == F.size("chars"), F.array(cut)).otherwise(F.array(skip, cut))

    entries = F.flatten(F.transform(F.sequence(F.lit(0), F.size("chars")), at))
    return both.select((-F.col("n")).alias("less"), "id", F.inline(entries))


def near_words(words: DataFrame) -> DataFrame:
    """(id, n_near, best) of words (id, word, n) with a near word; ``best`` is (less, id) of the first one.

    Near words differ by one inserted, deleted or replaced letter; the first is that with the
    largest n, then the smallest id. Each row looks at the two first skips and the cut of its
    pair, so no pairs of words are written out.
    """
    group = Window.partitionBy("p", "s")
    ordered = group.orderBy(F.col("kind") == _SPLIT, "less", "id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    me = F.struct("less", "id")
    skips, firsts = F.count_if(F.col("kind") != _SPLIT).over(group), F.count_if(F.col("kind") == _SKIP_FIRST).over(group)
    seen = _pairs(words).select(
        "id", me.alias("me"), "kind", skips.alias("skips"), firsts.alias("firsts"), F.count(F.lit(1)).over(group).alias("rows"),
        F.first(me).over(ordered).alias("one"), F.nth_value(me, 2).over(ordered).alias("two"), F.last(me).over(ordered).alias("last"),
    )
    with_cut = F.col("rows") > F.col("skips")
    other = F.when(F.col("skips") > 1, F.when(F.col("one") == F.col("me"), F.col("two")).otherwise(F.col("one")))
    is_cut = F.col("kind") == _SPLIT
    count = F.when(is_cut, F.col("firsts")).otherwise(F.col("skips") - 1 + (with_cut & (F.col("kind") == _SKIP_FIRST)).cast("long"))
    best = F.when(is_cut, F.col("one")).otherwise(F.least(other, F.when(with_cut, F.col("last"))))
    found = seen.where("rows > 1").select("id", count.alias("n_near"), best.alias("best"))
    return found.groupBy("id").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(id, root_id) of every word with a form, from (id, form_id).

    A form is ``ratio`` times as frequent as its word, so a chain is as long as the logarithm of
    the largest count; each round doubles the part of it that was followed.
    """
    reached = forms.withColumnRenamed("form_id", "root_id")
    while True:
        ahead = reached.select(F.col("id").alias("root_id"), F.col("root_id").alias("next_id"))
        moved = stage(reached.join(ahead, "root_id", "left"), "roots")
        reached = moved.select("id", F.coalesce("next_id", "root_id").alias("root_id"))
        if moved.where("next_id IS NOT NULL").isEmpty():
            return reached


def variants(counted: DataFrame, ratio: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of distinct words (word, n).

    A word's form is its near word of the largest n (ties: the smallest in code-point order) if
    that is at least ``ratio`` (2 or more) times the word's own n, else null; the root is
    where the forms lead. Words hold code points below 256 (see ``runs``); words of any length
    are handled whole, in space that grows with their length. An empty word has the words of
    one letter as near words. Rows with a null word or null n are left out; a word that comes
    twice is an error of the caller. Other columns are not looked at; an empty table gives no rows.
    """
    rows = counted.select("word", F.col("n").cast("long").alias("n")).where("word IS NOT NULL AND n IS NOT NULL")
    # numbers in code-point order; written, so that every later use sees the same ones
    words = stage(stage(rows, "word-counts").orderBy("word").select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")
    near = stage(near_words(words), "near-words")
    judged = words.join(near, "id", "left").withColumn("form_n", -F.col("best.less"))
    takes = F.col("form_n") >= ratio * F.col("n")
    forms = stage(judged.where(takes).select("id", F.col("best.id").alias("form_id")), "forms")
    named = lambda name: words.select(F.col("id").alias(f"{name}_id"), F.col("word").alias(name))
    led = forms.join(_roots(forms), "id").join(named("form"), "form_id").join(named("root"), "root_id").select("id", "form", "root")
    return judged.join(led, "id", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(takes, F.col("form_n")).alias("form_n")
    )
