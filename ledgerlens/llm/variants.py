"""Spelling variants of words by sorted permuterm rotations."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import release, stage

from .hashing import GOLDEN, mix

#: Marks a word's end in its rotations.
END = "$"
#: Maximal runs of these are words (fixed pattern).
LETTERS = "[A-Za-zÀ-ÿ]"
LOWER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}
#: Distinct words whose counts a task holds; the sums are made again behind the shuffle.
KEPT_WORDS = 500_000
#: Longer words' rotations are sorted by hashes: there are as many as code points, of that length each.
LONG = 64
#: Odd bases of the polynomials that hash long words (fixed values), modulo 2 ** 64.
BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)
#: Rounds of following forms; each doubles the steps, so this only stops a fault.
MAX_ROUNDS = 40


def _counter(shortest: int, typo_every: int | None):
    """mapInPandas over (name, text): (word, n), counted by task."""
    find = re.compile(f"{LETTERS}{{{shortest},}}").findall

    def run(batches):
        import zlib
        from collections import Counter

        import pandas as pd

        def rows(held):
            return pd.DataFrame({"word": list(held), "n": np.fromiter(held.values(), np.int64, len(held))})

        held: dict[str, int] = {}
        for batch in batches:
            for name, text in zip(batch["name"], batch["text"]):
                for word, n in Counter(find(text.translate(LOWER))).items():
                    if typo_every:
                        h = zlib.crc32(f"{name}:{word}".encode())
                        if h % typo_every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < shortest:
                                continue
                    held[word] = held.get(word, 0) + n
                if len(held) > KEPT_WORDS:
                    yield rows(held)
                    held = {}
        yield rows(held)

    return run


def word_counts(docs: DataFrame, shortest: int = 7, least: int = 2, typo_every: int | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(word, n): the maximal runs of letters A-Z, a-z and U+00C0 to U+00FF of all whole texts, with A-Z lower-cased, that
    have at least ``shortest`` code points and occur ``least`` times in all.

    With ``typo_every``, a run whose h = crc32 of ``<doc_id>:<run>`` that number divides first loses its code point
    h % length, which gives data with known slips. A null text has no words, a null id is an empty one. Repeated rows
    count each time. Other columns are left out, whatever their names. No rows: no rows.
    """
    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("name"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    counted = rows.mapInPandas(_counter(shortest, typo_every), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def rotations(words: DataFrame) -> DataFrame:
    """(key, place, skipped, first, n): the sorted rows of all rotations of the words (word, n) with their end marked.

    For the place i of a word u c v, |u| = i, the rotation v $ u c without its last character is the ``key``, ``skipped``
    that character c: what shares a key differs in c alone, or lacks it. The latter is the word u v itself, whose whole
    rotations v $ u stand here with nothing skipped. ``first`` is false where u ends in c: leaving out either gives
    the same word, so the pair would be met twice.
    """
    # 0 to length: whole rotations by the length of u; 1 to length: the character of that number is skipped
    places = "transform(sequence(0, length(word)), i -> struct(concat(substr(word, i + 1), '{0}', substr(word, 1, i)) as key, i as place, '' as skipped, true as first))"
    skips = (
        "transform(if(word = '', array(), sequence(1, length(word))), i -> struct(concat(substr(word, i + 1), '{0}', substr(word, 1, i - 1)) as key, i - 1 as place,"
        " substr(word, i, 1) as skipped, i = 1 or substr(word, i, 1) != substr(word, i - 1, 1) as first))"
    )
    both = words.select("n", F.explode(F.expr(f"concat({places}, {skips})".replace("{0}", END))).alias("x")).select("x.*", "n")
    return both.repartition("key", "place").sortWithinPartitions("key", "place")


def _scan(batches):
    """mapInArrow over sorted rotations: what each word of a group of several learns of its neighbours there:
    (word, near, best_n, best)."""
    import pyarrow as pa

    def group(key: str, place: int, rows: list[tuple]):
        """Rows are (skipped, first, n); a group has a word for each character at most, and one for none."""
        cut = len(key) - place  # where u begins
        left, right = key[cut:], key[: cut - 1]
        found = [(left + c + right, c, f, n) for c, f, n in rows]
        rank = lambda x: (-x[3], x[0])
        skips = sorted((x for x in found if x[1]), key=rank)
        whole = [x for x in found if not x[1]]
        firsts = [x for x in skips if x[2]]
        if whole and firsts:
            yield whole[0][0], len(firsts), firsts[0][3], firsts[0][0]
        for x in skips:
            others = [*skips[:1], *skips[1:2], *(whole if x[2] else [])]
            others = [y for y in others if y is not x]
            if others:
                best = min(others, key=rank)
                yield x[0], len(skips) - 1 + (len(whole) if x[2] else 0), best[3], best[0]

    def rows(found):
        word, near, n, best = zip(*found)
        return pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(near, pa.int64()), pa.array(n, pa.int64()), pa.array(best, pa.string())], ["word", "near", "best_n", "best"])

    for groups in _several(batches, ["key", "place"]):
        if found := [x for g in groups for x in group(g["key"][0], g["place"][0], list(zip(g["skipped"], g["first"], g["n"])))]:
            yield rows(found)


def _several(batches, by: list[str]):
    """The groups of two rows and more of sorted batches, as lists by column; one list of groups a batch."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def groups(table: pa.Table) -> list[dict]:
        if len(table) < 2:
            return []
        same = np.logical_and.reduce([pc.equal(table[c][1:], table[c][:-1]).to_numpy() for c in by])
        inside = np.flatnonzero(np.r_[False, same] | np.r_[same, False])
        part = {c: table[c].take(pa.array(inside)).to_pylist() for c in table.column_names}
        begins = np.flatnonzero(~np.r_[False, same][inside])
        return [{c: v[a:b] for c, v in part.items()} for a, b in zip(begins, [*begins[1:], len(inside)])]

    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
        if not len(held):
            continue
        # the last group may go on in the next batch
        last = np.logical_and.reduce([pc.equal(held[c], held[c][-1]).to_numpy() for c in by])
        end = len(held) - int(last.sum())
        yield groups(held.slice(0, end))
        held = held.slice(end)
    if held is not None:
        yield groups(held)


def _hashed_rotations(longest: int):
    """mapInPandas over (id, word, n): the rows of ``rotations`` with two hashes of u v for a key; words of
    ``longest`` code points have whole rotations only."""

    def powers(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[:1] = 1
        return np.cumprod(out)

    def run(batches):
        import pandas as pd

        for batch in batches:
            for name, word, n in zip(batch["id"], batch["word"], batch["n"]):
                c = np.array([ord(x) for x in word], np.uint64)
                h = mix(c + GOLDEN)
                keys, whole = [], []
                for base in BASES:
                    upto = np.zeros(len(c) + 1, np.uint64)
                    np.cumsum(h * powers(base, len(c)), out=upto[1:])
                    back = np.uint64(pow(base, -1, 1 << 64))
                    keys.append(mix(upto[:-1] + (upto[-1] - upto[1:]) * back).astype(np.int64))
                    whole.append(int(mix(upto[-1:]).astype(np.int64)[0]))
                place = np.arange(len(c) + 1)
                yield pd.DataFrame({"a": whole[0], "b": whole[1], "place": place, "skipped": -1, "first": True, "n": n, "id": name})
                if len(c) > longest:
                    first = np.r_[True, c[1:] != c[:-1]]
                    yield pd.DataFrame({"a": keys[0], "b": keys[1], "place": place[:-1], "skipped": c.astype(np.int64), "first": first, "n": n, "id": name})

    return run


def _scan_hashed(batches):
    """mapInArrow over sorted rows of ``_hashed_rotations``: (id, near, best_n, best_id), the best of those of the same
    length and the one of another apart."""
    import pyarrow as pa

    for groups in _several(batches, ["a", "b", "place"]):
        found = []
        for g in groups:
            rows = sorted(zip(g["skipped"], g["first"], g["n"], g["id"]), key=lambda x: (-x[2], x[0]))
            skips, whole = [x for x in rows if x[0] >= 0], [x for x in rows if x[0] < 0]
            firsts = [x for x in skips if x[1]]
            for w in whole[:1]:
                found += [(w[3], len(firsts), x[2], x[3]) for x in firsts[:1]]
                found += [(x[3], 1, w[2], w[3]) for x in firsts]
            if len(skips) > 1:
                found += [(x[3], len(skips) - 1, *skips[1 if x is skips[0] else 0][2:]) for x in skips]
        if found:
            columns = [pa.array(c, pa.int64()) for c in zip(*found)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "near", "best_n", "best_id"])


def _met(words: DataFrame) -> DataFrame:
    """(word, near, best_n, best): what words learn of neighbours, group by group."""
    size = F.length("word")
    met = rotations(words.where(size <= LONG)).mapInArrow(_scan, "word string, near long, best_n long, best string")
    # pairs with a longer word
    named = words.where(size >= LONG).select(F.xxhash64("word").alias("id"), "word", "n")
    rows = named.mapInPandas(_hashed_rotations(LONG), "a long, b long, place int, skipped int, first boolean, n long, id long")
    rows = rows.repartition("a", "b", "place").sortWithinPartitions("a", "b", "place")
    far = rows.mapInArrow(_scan_hashed, "id long, near long, best_n long, best_id long")
    best = named.select(F.col("id").alias("best_id"), F.col("word").alias("best"))
    far = far.join(best, "best_id").join(named.select("id", "word"), "id")
    return met.unionByName(far.select("word", "near", "best_n", "best"))


def spelling_variants(words: DataFrame, ratio: int = 10, word: str = "word", count: str = "n") -> DataFrame:
    """(word, n, n_near, form, form_n, root), a row for each distinct word.

    Two words are near if they differ by exactly one inserted, deleted or replaced code point. ``form`` is the near
    word of the largest count, of several the smallest in code-point order, if that count is at least ``ratio`` times the
    word's; else null. ``root`` is what following forms ends at, the word itself without one.

    All rotations of the words are sorted; words that an edit of one character joins stand together there, at
    most one for each character of the alphabet. A scan tells each of them how many it met and the best; no pair is
    written. So the work grows with the words' lengths, not with the square of anything.

    Counts of repeated words are added up, null words left out, null counts none. An empty word is near words of one
    code point. Words may hold any characters; rotations of those of more than LONG code points are told apart by two 64-bit
    hashes instead of being written out. Other columns are left out, whatever their names. No rows: no rows.
    """
    if ratio < 2:
        raise ValueError("a form must be more frequent than the word")
    words = words.select(F.col(word).alias("word"), F.col(count).cast("long").alias("n")).where("word is not null")
    words = stage(words.groupBy("word").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")), "words")
    met = _met(words)
    # of the largest count the smallest word
    near = met.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("form"))).alias("b"))
    known = words.join(near, "word", "left")
    form_n = -F.col("b.less")
    fits = (form_n >= ratio * F.col("n")) & (form_n > F.col("n"))
    known = known.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fits, F.col("b.form")).alias("form"), F.when(fits, form_n).alias("form_n"))
    known = stage(known, "forms")
    # every step doubles; counts grow with each form, so there are no circles
    root = stage(known.where("form is not null").select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    for _ in range(MAX_ROUNDS):
        on = root.select(F.col("word").alias("root"), F.col("root").alias("far"))
        step = root.drop("moved").join(on, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved"))
        last, root = root, stage(step, "roots")
        release(last)
        if root.where("moved").isEmpty():
            break
    root = root.drop("moved")
    return known.join(root, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
