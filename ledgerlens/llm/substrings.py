"""Repeated passages by fixed-block anchors, extended to maximal exact repeats."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import shuffle_partitions

from .hashing import GOLDEN, mix

#: Words of a repeat at least; each holds one whole reference block of BLOCK words, wherever blocks begin.
WINDOW = 13
#: Odd bases of the polynomials that hash runs of words (fixed values), modulo 2 ** 64.
BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5, 0x9FB21C651E98DF25)
#: Bytes and number of texts that a task takes together, and bytes of text that a part of the index stands for.
CHUNK, CHUNK_TEXTS, PART_BYTES = 3 << 20, 1 << 15, 12 << 20
#: Bits of a block's hash within its part.
BITS = 30
#: Documents of one chunk in which a run that starts no block there is told one by one; of more it is taken as found.
MANY = 16
#: Stands for a null id, which comes after all others.
LAST = (1 << 63) - 1


class Powers:
    """Powers of an odd base and of its inverse modulo 2 ** 64, as far as asked for."""

    def __init__(self, base: int):
        self.bases = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            n += n >> 3
            self.up, self.down = (np.full(n, b, np.uint64) for b in self.bases)
            for x in (self.up, self.down):
                x[0] = 1
                np.cumprod(x, out=x)
        return self.up, self.down


POWERS = [Powers(b) for b in BASES]
BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
BYTES = mix(np.arange(1, 257, dtype=np.uint64) * GOLDEN)


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of texts, one text after the other, and how many each has: of all bytes at
    once, by prefix sums of a polynomial in them."""
    data = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
    blank = BLANK[data]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    start, end = edge[::2], edge[1::2]
    begin = np.cumsum([1, *(len(t) + 1 for t in texts)])
    n = np.diff(np.searchsorted(start, begin))
    up, down = POWERS[0](len(data))
    total = BYTES[data]
    total *= up[: len(data)]
    np.cumsum(total, out=total)
    return mix((total[end - 1] - total[start - 1]) * down[start]), n


def utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace")


def windows(h: np.ndarray, size: int, seed: int) -> np.ndarray:
    """A hash of each run of ``size`` words, from prefix sums of a polynomial in their hashes."""
    if len(h) < size:
        return np.zeros(0, np.uint64)
    up, down = POWERS[seed](len(h))
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * up[: len(h)], out=total[1:])
    return mix((total[size:] - total[:-size]) * down[: len(h) - size + 1])


def _chunks(batch):
    """Parts of a batch of about CHUNK bytes."""
    held, start = 0, 0
    for i, t in enumerate(batch["text"]):
        held += len(t)
        if held >= CHUNK or i - start + 1 >= CHUNK_TEXTS:
            yield batch.iloc[start : i + 1]
            held, start = 0, i + 1
    if start < len(batch):
        yield batch.iloc[start:]


def _code(h: np.ndarray, parts: int) -> np.ndarray:
    """A block's part and its hash there, as one number."""
    return (((h >> np.uint64(32)) % np.uint64(parts)) << np.uint64(BITS)) | (h & np.uint64((1 << BITS) - 1))


def _steps(places: np.ndarray) -> bytes:
    return np.diff(places, prepend=0).astype("<u4").tobytes()


def _places(steps: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(steps, "<u4").astype(np.int64))


def _firsts(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before."""
    new = np.ones(len(columns[0]), bool)
    if len(new) > 1:
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return np.flatnonzero(new)


def _sorted(code: np.ndarray, owner: np.ndarray, parts: int) -> np.ndarray:
    """The order by code, then owner; both fit one number but for very many parts."""
    bits = int(owner[-1]).bit_length()
    if (parts << BITS).bit_length() + bits > 64:
        return np.lexsort((owner, code))
    return np.argsort((code << np.uint64(bits)) | owner.astype(np.uint64))


def _cuts(part: np.ndarray):
    """(part, slice of its entries) of entries sorted by part."""
    at = _firsts(part) if len(part) else np.zeros(0, np.int64)
    for a, b in zip(at, [*at[1:], len(part)]):
        yield int(part[a]), slice(a, b)


def _grown(values: np.ndarray) -> bytes:
    """Ascending numbers as steps, which compress well."""
    return np.diff(values, prepend=0).astype("<i8").tobytes()


def _chunk_name(row: np.ndarray) -> int:
    """By what it holds, so a task that runs again gives its chunks the same names."""
    import xxhash

    return xxhash.xxh3_64_intdigest(row.tobytes()) - (1 << 63)


#: The names of a chunk's rows, and places already found there, go by the chunk; they have these parts below zero.
ROWS, PLACES = 0, 1
MESSAGE = "part int, chunk long, docs binary, ids binary, keys binary, known binary"


def _own(kind: int, chunk: int, parts: int) -> int:
    return -1 - kind - 2 * (chunk % parts)


def _found(owner: np.ndarray, place: np.ndarray, row: np.ndarray, chunk: int, parts: int) -> list[tuple]:
    """What every chunk says of itself: its rows, and the places found there, sorted by row and place."""
    docs, counts = np.unique(owner, return_counts=True)
    steps = np.diff(place, prepend=0)
    begin = np.cumsum(counts) - counts
    steps[begin] = place[begin]
    return [
        (_own(ROWS, chunk, parts), chunk, b"", b"", row.astype("<i8").tobytes(), b""),
        (_own(PLACES, chunk, parts), chunk, docs.astype("<u2").tobytes(), counts.astype("<u4").tobytes(), steps.astype("<u4").tobytes(), b""),
    ]


def _probes(block: int, window: int, parts: int):
    """mapInPandas over (row, text): for each part of the index, the runs of ``block`` words of these
    documents, each once a document, marked where one is a reference block (those that begin at multiples of
    ``block``).

    A run that several documents of a chunk have, and one of them as a block, is found there: it is told
    once, and the places stay with the chunk.
    """

    def run(batches):
        import pandas as pd

        for batch in batches:
            for texts in _chunks(batch):
                texts = texts.drop_duplicates("row")
                row = texts["row"].to_numpy()
                h, n = hashed_words([utf8(t) for t in texts["text"]])
                code = _code(windows(h, block, 0), parts)
                owner = np.repeat(np.arange(len(n), dtype=np.int32), n)[: len(code)]
                place = np.arange(len(code)) - (np.cumsum(n) - n)[owner]
                own = np.flatnonzero((place + block <= n[owner]) & (n[owner] >= window))
                if not len(own):
                    continue
                order = own[_sorted(code[own], owner[own], parts)]
                key, doc = code[order], owner[order]
                entry = _firsts(key, doc)
                is_block = np.logical_or.reduceat(place[order] % block == 0, entry)
                entry_key, entry_doc = key[entry], doc[entry]
                first = _firsts(entry_key)
                docs = np.diff(first, append=len(entry))
                live = (docs > 1) & np.logical_or.reduceat(is_block, first) | (docs > MANY)
                entry_live = np.repeat(live, docs)
                place_live = np.zeros(len(code), bool)
                place_live[order] = np.repeat(entry_live, np.diff(entry, append=len(key)))
                at = np.flatnonzero(place_live)
                chunk = _chunk_name(row)
                out = _found(owner[at], place[at], row, chunk, parts)
                # what is not yet found
                keep = np.flatnonzero(~entry_live)
                part = (entry_key[keep] >> np.uint64(BITS)).astype(np.int64)
                order = np.lexsort((entry_doc[keep], part))
                keep, part = keep[order], part[order]
                low = (entry_key[keep] & np.uint64((1 << BITS) - 1)).astype("<u4") | (is_block[keep].astype("<u4") << np.uint32(31))
                told = np.sort(entry_key[first[live]])
                known = {p: (told[s] & np.uint64((1 << BITS) - 1)).astype("<u4").tobytes() for p, s in _cuts(told >> np.uint64(BITS))}
                for p, s in _cuts(part):
                    out.append((p, chunk, entry_doc[keep[s]].astype("<u2").tobytes(), b"", low[s].tobytes(), known.pop(p, b"")))
                out += [(p, chunk, b"", b"", b"", k) for p, k in known.items()]
                yield pd.DataFrame(out, columns=["part", "chunk", "docs", "ids", "keys", "known"])

    return run


def _joined(column, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind)


def _answers(group, part: int, message: np.ndarray, doc: np.ndarray, data: np.ndarray):
    """Entries of messages, sorted by message, as answers to the messages' chunks."""
    import pandas as pd

    chunks = group["chunk"].to_numpy()
    out = [(chunks[m], part, doc[s].astype("<u2").tobytes(), b"", data[s].tobytes()) for m, s in _cuts(message)]
    return pd.DataFrame(out, columns=["chunk", "part", "docs", "counts", "data"])


def _passed(group):
    """Messages that go by the chunk anyhow."""
    out = group[["chunk", "part", "docs"]].assign(counts=group["ids"], data=group["keys"])
    # all that matters from here is the kind
    return out.assign(part=-1 - (-1 - out["part"]) % 2)


def _hits(group):
    """Of one part of the index: for each chunk its documents' runs that are a block of another or may be."""
    if int(group["part"].iloc[0]) < 0:
        return _passed(group)
    key, doc = _joined(group["keys"], "<u4"), _joined(group["docs"], "<u2")
    message = np.repeat(np.arange(len(group)), [len(k) // 4 for k in group["keys"]])
    low, is_block = key & np.uint32((1 << BITS) - 1), key >> np.uint32(31) != 0
    order = np.argsort(low, kind="stable")
    live = np.zeros(len(low), bool)
    if len(low):
        sorted_low, who = low[order], (message[order] << 16) | doc[order]
        first = _firsts(sorted_low)
        count = np.diff(first, append=len(low))
        # entries stand by message and document within a run: the first and last differ if any do
        several = who[first] != who[first + count - 1]
        live[order] = np.repeat(several & np.logical_or.reduceat(is_block[order], first), count)
    live |= np.isin(low, np.unique(_joined(group["known"], "<u4")))
    return _answers(group, int(group["part"].iloc[0]), message[live], doc[live], low[live].astype("<u4"))


def _by_row(size: str):
    """applyInPandas over the answers to one chunk: (row, places, keys) of its documents. ``size`` is the type of
    answered keys; those of four bytes become whole numbers with their part."""

    def run(group):
        import pandas as pd

        row = [_joined([d], "<i8") for p, d in zip(group["part"], group["data"]) if p == -1 - ROWS][0]
        places, keys = {}, {}
        docs, data = [np.zeros(0, "<u2")], [np.zeros(0, np.uint64)]
        for part, d, counts, x in zip(group["part"], group["docs"], group["counts"], group["data"]):
            if part == -1 - PLACES:
                ends = 4 * np.cumsum(np.frombuffer(counts, "<u4"))
                for i, a, b in zip(np.frombuffer(d, "<u2").tolist(), [0, *ends], ends):
                    places[i] = x[a:b]
            elif part >= 0:
                docs.append(np.frombuffer(d, "<u2"))
                key = np.frombuffer(x, size).astype(np.uint64)
                data.append(key | np.uint64(part << BITS) if size == "<u4" else key)
        doc, key = np.concatenate(docs), np.concatenate(data)
        order = np.argsort(doc, kind="stable")
        key = key[order]
        for i, s in _cuts(doc[order]):
            keys[i] = key[s].tobytes()
        both = sorted({*places, *keys})
        return pd.DataFrame({"row": row[both], "places": [places.get(i, b"") for i in both], "keys": [keys.get(i, b"") for i in both]})

    return run


def _extensions(block: int, window: int, parts: int):
    """mapInPandas over (row, id, text, found): the hashes of the runs of ``window`` words around hits.

    Of documents of one chunk that have a run, only those of the least id go on to be compared; for the
    others it is a repeat, and its places stay with the chunk.
    """

    def run(batches):
        import pandas as pd

        for batch in batches:
            for texts in _chunks(batch):
                # by id, so that ids are told by small steps
                texts = texts.drop_duplicates("row").sort_values(["id", "row"])
                h, n = hashed_words([utf8(t) for t in texts["text"]])
                row, number = texts["row"].to_numpy(), texts["id"].to_numpy()
                first = np.cumsum(n) - n
                code = _code(windows(h, block, 0), parts)
                change = np.zeros(len(h) + 1, np.int32)
                for i, found in enumerate(texts["found"]):
                    hits = [_places(x["places"]) for x in found]
                    keys = np.concatenate([np.frombuffer(x["keys"], "<u8") for x in found])
                    if len(keys):
                        hits.append(np.flatnonzero(np.isin(code[first[i] : first[i] + n[i] - block + 1], keys)))
                    hits = np.concatenate(hits)
                    low, high = np.maximum(hits - (window - block), 0), np.minimum(hits, n[i] - window)
                    np.add.at(change, first[i] + low, 1)
                    np.add.at(change, first[i] + high + 1, -1)
                start = np.flatnonzero(np.cumsum(change[:-1]) > 0)
                if not len(start):
                    continue
                key, part = windows(h, window, 1)[start], (windows(h, window, 2)[start] % np.uint64(parts)).astype(np.int64)
                owner = np.searchsorted(first, start, "right") - 1
                order = np.lexsort((owner, key))  # owners stand by their ids
                key, part, owner, start = key[order], part[order], owner[order], start[order]
                same = _firsts(key)
                least = np.repeat(number[owner[same]], np.diff(same, append=len(key)))
                late = number[owner] > least
                at = np.flatnonzero(late)
                at = at[np.argsort(start[at])]
                chunk = _chunk_name(row)
                out = _found(owner[at], start[at] - first[owner[at]], row, chunk, parts)
                once = np.zeros(len(key), bool)
                once[_firsts(key, owner)] = True
                at = np.flatnonzero(once & ~late)
                at = at[np.lexsort((owner[at], part[at]))]
                for p, s in _cuts(part[at]):
                    o = owner[at[s]]
                    out.append((p, chunk, o.astype("<u2").tobytes(), _grown(number[o]), key[at[s]].astype("<u8").tobytes(), b""))
                yield pd.DataFrame(out, columns=["part", "chunk", "docs", "ids", "keys", "known"])

    return run


def _repeats(group):
    """Of one part of the runs: for each chunk those that a document of smaller id than its own has too."""
    if int(group["part"].iloc[0]) < 0:
        return _passed(group)
    key, doc = _joined(group["keys"], "<u8"), _joined(group["docs"], "<u2")
    number = np.concatenate([np.cumsum(np.frombuffer(x, "<i8")) for x in group["ids"]])
    message = np.repeat(np.arange(len(group)), [len(k) // 8 for k in group["keys"]])
    order = np.lexsort((number, key))
    first = _firsts(key[order])
    late = np.zeros(len(key), bool)
    late[order] = number[order] > np.repeat(number[order][first], np.diff(first, append=len(key)))
    return _answers(group, int(group["part"].iloc[0]), message[late], doc[late], key[late])


def _kept(window: int):
    """mapInPandas over (doc_id, text, found): the spans of words that repeats cover, and the words left."""

    def run(batches):
        import pandas as pd

        for batch in batches:
            out = []
            for text, found in zip(batch["text"], batch["found"]):
                data = utf8(text)
                split = data.split()  # bytes.split() parts at exactly these blanks
                covered = np.zeros(len(split) + 1, np.int32)
                if found is not None and len(found):
                    starts = [_places(x["places"]) for x in found]
                    keys = np.concatenate([np.frombuffer(x["keys"], "<u8") for x in found])
                    if len(keys):
                        starts.append(np.flatnonzero(np.isin(windows(hashed_words([data])[0], window, 1), keys)))
                    starts = np.unique(np.concatenate(starts))
                    covered[starts] += 1
                    np.add.at(covered, starts + window, -1)
                gone = np.cumsum(covered[:-1]) > 0
                edge = np.flatnonzero(np.diff(np.r_[False, gone, False]))
                spans = [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])]
                left = split if not spans else [w for w, g in zip(split, gone.tolist()) if not g]
                out.append((len(split), int(gone.sum()), spans, b" ".join(left).decode()))
            made = pd.DataFrame(out, columns=["n_words", "n_removed", "spans", "kept_text"])
            yield pd.concat([batch[["doc_id"]].reset_index(drop=True), made], axis=1)

    return run


def drop_repeats(docs: DataFrame, window: int = WINDOW, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept_text), a row for each row of ``docs``: its text without the words
    of passages that a document of smaller id has too.

    Words stand between blanks. A passage is a maximal run of words every ``window`` of which, taken together, also
    start in a document with a smaller integer id; ``spans`` are their places (``end`` is the first word after),
    judged on the input, and ``kept_text`` is the rest, joined by single spaces.

    The index holds the blocks of (window + 1) / 2 words that begin at multiples of that number in each
    document: every run of ``window`` words has one of them whole, wherever it begins. All
    rolling runs of that many words probe the index, by hash within a part. Around each hit the run is
    extended to all of ``window`` words that have it, and the extended runs of both sides are compared by
    64-bit hashes within parts dealt by another hash; those found, chained, are the maximal repeats. A task
    works on chunks of texts and tells what a chunk's documents share only once, so a passage of a third of all documents
    is a few entries for each chunk. Entries name a document by its place in the chunk; answers go by the chunk. Texts are exchanged once, by document; both later reads share that exchange.

    A null text has no words; a text of fewer than ``window`` words stays whole. A null id comes after all
    others; rows of one id, or without, leave each other alone, and repeated rows get equal results. Very
    long texts are read whole. Other columns are left out, whatever their names. No rows: no rows.
    """
    if window < 2:
        raise ValueError("a repeat has two words at least")
    block = (window + 1) // 2
    spark = docs.sparkSession
    whole = docs.select(
        F.xxhash64(F.col(doc_id), F.coalesce(F.col(text), F.lit(""))).alias("row"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("id"),
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = max(shuffle_partitions(spark), math.ceil(size / PART_BYTES))
    kind = dict(whole.dtypes)["doc_id"]

    answer = "chunk long, part int, docs binary, counts binary, data binary"

    def of_row(messages: DataFrame, reduce, size: str) -> DataFrame:
        """Messages by part, answers by chunk, and what a row learns."""
        answers = messages.groupBy("part").applyInPandas(reduce, answer)
        found = answers.groupBy("chunk").applyInPandas(_by_row(size), "row long, places binary, keys binary")
        return found.groupBy(F.col("row").alias("r")).agg(F.collect_list(F.struct("places", "keys")).alias("found"))

    hits = of_row(whole.select("row", "text").mapInPandas(_probes(block, window, parts), MESSAGE), _hits, "<u4")
    # both joins read the same columns of the texts, so that one exchange of them serves both
    texts = ["row", "id", "doc_id", "text"]
    near = whole.join(hits, F.col("row") == F.col("r")).select(*texts, "found")
    repeats = of_row(near.mapInPandas(_extensions(block, window, parts), MESSAGE), _repeats, "<u8")
    rows = whole.join(repeats, F.col("row") == F.col("r"), "left").select(*texts, "found")
    return rows.mapInPandas(_kept(window), f"doc_id {kind}, n_words long, n_removed long, spans array<struct<start: long, end: long>>, kept_text string")
