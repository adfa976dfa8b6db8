"""Token pieces and best-fit packing by the counts of their sizes."""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import shuffle_partitions, stage, tidied

from .common import fresh, others

#: Words whose ids a worker process keeps, first come first kept; about 150 MB.
KEPT_WORDS = 600_000

PIECES = "piece int, start long, length long, ids_crc32 long, ids binary"
#: How the tokenizer parts lower-cased Latin-1 text into words (fixed pattern, narrowed to that range).
LATIN_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]|[^a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe]+"


def byte_letters() -> list[str]:
    """The letter by which a byte-level vocabulary writes each byte: itself if printable, else one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


def word_ids(tokenizer: str) -> dict[str, bytes]:
    """Little-endian ids of any text without blanks, by look-up; what is asked for first is encoded and kept.

    The tokenizer ``word_bpe_49k.json`` parts its text into words and encodes each alone. For printable Latin-1,
    which its normalizer only lower-cases, the parting is done here and only the words go to its
    merges; any other text goes through the whole tokenizer. Worker processes are used for many tasks, so
    the table is kept for the life of the process.
    """
    import re
    import sys
    from array import array
    from types import ModuleType

    import public_tokenizers
    from tokenizers import Tokenizer

    kept = sys.modules.setdefault("ledgerlens_kept_words", ModuleType("ledgerlens_kept_words"))
    if tokenizer in kept.__dict__:
        return kept.__dict__[tokenizer]
    coder = Tokenizer.from_file(public_tokenizers.path(tokenizer))
    tokenize, parted, letters = coder.model.tokenize, re.compile(LATIN_WORDS).findall, byte_letters()
    words: dict[str, bytes] = {}

    def one(word):
        if (got := words.get(word)) is None:
            # printable ASCII is written as itself
            spelt = word if word.isascii() else "".join([letters[b] for b in word.encode()])
            got = array("I", [t.id for t in tokenize(spelt)]).tobytes()
            if len(words) < KEPT_WORDS // 2:
                words[word] = got
        return got

    class Ids(dict):
        def __missing__(self, text):
            if text.isalpha() and text.isascii():
                found = one(text.lower())
            elif text.isprintable() and max(text, default=" ") < "\u0100" and "<|" not in text:
                found = b"".join(map(one, parted(text.lower())))
            else:
                found = array("I", coder.encode(text, add_special_tokens=False).ids).tobytes()
            if len(self) < KEPT_WORDS // 2:
                self[text] = found
            return found

    kept.__dict__[tokenizer] = Ids()
    return kept.__dict__[tokenizer]


def _piece_maker(tokenizer: str, capacity: int, end: int, keep_ids: bool):
    def make(batches):
        import zlib

        import pandas as pd

        ids_of = word_ids(tokenizer).__getitem__
        stop, wide = end.to_bytes(4, "little"), 4 * capacity
        for docs in batches:
            rows = []
            for at, text in enumerate(docs["text"]):
                # the tokenizer never joins across these blanks
                ids = b"".join(map(ids_of, (text or "").replace("\n", " ").split(" "))) + stop
                for start in range(0, len(ids), wide):
                    data = ids[start : start + wide]
                    rows.append((at, start // wide, start // 4, len(data) // 4, zlib.crc32(data), data if keep_ids else None))
            made = pd.DataFrame(rows, columns=["at", "piece", "start", "length", "ids_crc32", "ids"])
            kept = docs.drop(columns="text").iloc[made.pop("at")].reset_index(drop=True)
            yield pd.concat([kept, made], axis=1)

    return make


def token_pieces(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", capacity: int = 4096, end: int = 1, keep_ids: bool = False, text: str = "text", doc_id: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """Pieces of at most ``capacity`` tokens of every document: (doc_id, *keep, piece, start, length, ids_crc32, ids).

    A document's ids are the tokenizer's, then ``end``; a null text is empty and so has one token. Only
    longer ones are cut. ``ids`` are little-endian unsigned 32-bit numbers, null unless ``keep_ids``.
    ``tokenizer`` is the name of a file of the public tokenizers that parts words as
    ``word_bpe_49k.json`` does. Whole texts are encoded, however long. Rows with a null id, and repeated rows, are cut
    each on its own. Columns but those of ``keep`` are left out, whatever their names. No rows: no rows.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), *keep, F.col(text).alias("text"))
    kinds = ", ".join(f"{c} {kind}" for c, kind in rows.dtypes[:-1])
    return rows.mapInPandas(_piece_maker(tokenizer, capacity, end, keep_ids), f"{kinds}, {PIECES}")


def best_fit(counts: list[tuple[int, int]], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best fit, largest first, of ``n`` pieces of each size: (size, before, each, first, offset) for each step.

    Sequences with equal gaps that follow each other are filled as one: of the pieces of a size, those from place
    ``before`` on go to sequence ``first`` and the next ones, ``each`` in a sequence, from ``offset`` on. Pieces of a size go
    one by one to the smallest gap that they fit, or to a new sequence; where that leaves a gap that they fit, it is
    the smallest, so a sequence takes as many as it can. The work depends on the number of sizes, not on that of pieces.
    """
    steps: list[tuple[int, int, int, int, int]] = []
    spans: dict[int, list[tuple[int, int]]] = {}
    gaps: list[int] = []
    opened = 0

    def put(gap, first, many):
        if gap and many:
            if gap not in spans:
                insort(gaps, gap)
                spans[gap] = []
            spans[gap].append((first, many))

    for size, n in sorted(counts, reverse=True):
        done = 0
        while done < n:
            at = bisect_left(gaps, size)
            if at < len(gaps):
                gap = gaps[at]
                first, many = spans[gap].pop()
                if not spans[gap]:
                    del spans[gap], gaps[at]
            else:
                gap, first, many = capacity, opened, -(-(n - done) // (capacity // size))
                opened += many
            each = gap // size
            full = min(many, (n - done) // each)
            # where the pieces end, one sequence takes fewer
            for of, taking in ((full, each), (min(many - full, 1), n - done - full * each)):
                if of and taking:
                    steps.append((size, done, taking, first, capacity - gap))
                    put(gap - taking * size, first, of)
                    first, many, done = first + of, many - of, done + of * taking
            put(gap, first, many)
    return steps


def _planner(capacity: int):
    def plan(counts):
        import pandas as pd

        steps = best_fit([*zip(counts["size"].tolist(), counts["n"].tolist())], capacity)
        made = pd.DataFrame(steps, columns=["size", "before", "each", "first", "offset"])
        made.insert(0, "run", counts["run"].iloc[0])
        return made

    return plan


@tidied
def pack_best_fit(pieces: DataFrame, capacity: int = 4096, length: str = "length", run: str | None = None) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces of 1 to ``capacity`` tokens.

    Best fit, largest first: a piece goes to the sequence with the smallest gap that it fits, or opens one. Pieces of one size
    are alike, so the steps are made from how many there are of each, at most ``capacity`` numbers a run, in one
    small task for each run; each piece then finds its step by its place among those of its size. Pieces are
    exchanged for that place and never grouped by size alone, so one size may have most of them. With ``run``, a
    column of whole numbers from 0, a sequence has pieces of one run only: all runs are packed at once, each on its own,
    which costs a sequence or two for each run.

    Input columns of these names are replaced. A null length, or one outside the range, is an error; a null run is 0.
    No rows: no rows. Equal rows may swap places.
    """
    bad = F.raise_error(F.lit("a piece must have 1 to capacity tokens")).cast("long")
    fits = F.col(length).isNotNull() & F.col(length).between(1, capacity)
    names = others(pieces, "sequence_id", "offset")
    piece, own, of, part, place, steps = fresh(pieces, "_piece", "_size", "_run", "_part", "_place", "_steps")
    owner = F.coalesce(F.col(run).cast("long"), F.lit(0).cast("long")) if run else F.lit(0).cast("long")
    pieces = pieces.select(*names, F.when(fits, F.col(length).cast("long")).otherwise(bad).alias(own), F.monotonically_increasing_id().alias(piece), owner.alias(of))
    pieces = stage(pieces, "pieces")
    # pieces of one size may be a third of all
    parts = shuffle_partitions(pieces.sparkSession)
    pieces = pieces.withColumn(part, F.pmod(F.xxhash64(piece), F.lit(parts)).cast("int"))
    shares = pieces.groupBy(F.col(of).alias("run"), F.col(own).alias("size"), F.col(part).alias("part")).agg(F.count(F.lit(1)).alias("n"))
    shares = stage(shares, "shares")
    counts = shares.groupBy("run", "size").agg(F.sum("n").alias("n"))
    made = counts.groupBy("run").applyInPandas(_planner(capacity), "run long, size long, before long, each long, first long, offset long")
    made = made.groupBy("run", "size").agg(F.sort_array(F.collect_list(F.struct("before", "each", "first", "offset"))).alias("steps"))
    # the steps that a share's places reach: from the last that begins up to its first place
    upto = Window.partitionBy("run", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.withColumn("from", F.coalesce(F.sum("n").over(upto), F.lit(0)))
    early = F.size(F.filter("steps", lambda s: s["before"] <= F.col("from")))
    reached = F.size(F.filter("steps", lambda s: s["before"] < F.col("from") + F.col("n")))
    shares = shares.join(made, ["run", "size"])
    shares = stage(shares.select(F.col("run").alias(of), F.col("size").alias(own), F.col("part").alias(part), F.col("from").alias(place), F.slice("steps", early, reached - early + 1).alias(steps)), "steps")
    within = Window.partitionBy(of, own, part).orderBy(piece)
    out = pieces.withColumn(piece, F.row_number().over(within) - 1).join(shares, [of, own, part])
    out = out.withColumn(place, F.col(place) + F.col(piece))
    out = out.withColumn(steps, F.element_at(F.filter(steps, lambda s: s["before"] <= F.col(place)), -1))
    step, ahead = F.col(steps), F.col(place) - F.col(steps)["before"]
    # the run stands in the upper bits
    sequence = F.col(of) * F.lit(1 << 40) + step["first"] + F.call_function("div", ahead, step["each"])
    offset = step["offset"] + ahead % step["each"] * F.col(own)
    return out.select(*names, sequence.alias("sequence_id"), offset.alias("offset"))
