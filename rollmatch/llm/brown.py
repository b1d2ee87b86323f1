"""Language-model scores from class-based n-grams with exchange clustering.

Tokens are words (A-Z in lower case) and one end per text. The model is learnt from all
rows outside the held-out fold:

* exact counts of every word (map-side tables, summed by word);
* bigram counts among the ``cluster_words`` most frequent words (the core), everything else
  as one rare word, and the end, from a second pass over all texts (a task adds them up in
  one matrix of fixed size);
* exchange clustering of the core into ``classes`` classes: every word in turn moves to
  the class that raises the likelihood of the class bigrams most, until none moves. Its
  input is the bigram matrix, whose size is a parameter;
* a class for every other training word: the core classes before and after it (the rare
  word where a neighbour is outside the core) are counted in a third pass, summed by word,
  and the word joins the class that raises the likelihood most, given the core's bigrams;
* class bigrams of all training text with those classes, from a fourth pass. Only words
  without a count in the training text stay in the rare class;
* log10 P(text) = sum of log10 P(class | class before) + log10 P(word | class), with
  additive smoothing of the transitions; in the rare class every word counts as the same one.

Counting and scoring look frequent words up in a broadcast table of ``table_words`` entries.
The other words meet their counts and classes in joins: in training as distinct neighbours,
in scoring as the distinct words of a row, whose classes come back to the class pairs they
are part of. All passes but the first read the texts as numbers, written once. Words longer than ``max_chars`` never enter the table.

NULL and empty texts hold one token, the end. A NULL id falls into the held-out fold
(its crc32 counts as 0). Repeated rows each get their own score. Without any training
text all counts are 0.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmatch.llm.common import most_frequent, per_text, small_batches, written

RARE, END = 0, 1  # numbers of the rare word and of the end, before the clustered words


def held_out(id_col: str, folds: int) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(folds)), F.lit(0)) == 0


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def word_counts(texts: DataFrame, text_col: str, most: int = 250_000) -> DataFrame:
    """(w, c) of every word of all texts; a task's table is passed on whenever it holds ``most`` words."""

    def count(batches):
        table: Counter = Counter()

        def rows():
            return pd.DataFrame({"w": [w.decode("utf-8", "replace") for w in table], "n": list(table.values())})

        for batch in batches:
            for text in batch[text_col]:
                if text:
                    table.update(words_of(text))
                    if len(table) > most:
                        yield rows()
                        table.clear()
        if table:
            yield rows()

    return texts.select(text_col).mapInPandas(count, "w string, n long").groupBy("w").agg(F.sum("n").alias("c"))


def encoded(docs: DataFrame, words: list[str]) -> DataFrame:
    """(row, id, ids, words, times): a text's words as 32-bit numbers, the place in ``words`` or, of the row's other
    word j, -1 - j; these words and how often each occurs."""
    shared = docs.sparkSession.sparkContext.broadcast({"words": words})

    def make():
        held = shared.value
        if "number" not in held:
            held["number"] = {w.encode(): i for i, w in enumerate(held["words"])}
        number = held["number"].get

        def encode(text: str):
            words = words_of(text)
            at = np.fromiter(map(number, words, repeat(-1)), "<i4", len(words))
            place = np.flatnonzero(at < 0).tolist()
            rare = Counter(words[i] for i in place)
            if rare:
                j = {w: -1 - x for x, w in enumerate(rare)}
                at[place] = [j[words[i]] for i in place]
            return at.tobytes(), [w.decode("utf-8", "replace") for w in rare], list(rare.values())

        return encode

    part = per_text(make, "ids binary, words array<string>, times array<long>")
    return written(docs.select(F.monotonically_increasing_id().alias("row"), "id", part(F.col("text")).alias("r")).select("row", "id", "r.*"), "encoded")


def running_text(batch: pa.RecordBatch, end: int) -> tuple[np.ndarray, pa.Array]:
    """All texts of a batch in one row of numbers, ``end`` before, between and after them; and the words of numbers -1, -2, .."""
    parts, before = [np.array([end])], 0
    for raw, n in zip(batch.column("ids").to_pylist(), batch.column("words").value_lengths().to_pylist()):
        at = np.frombuffer(raw, "<i4").astype(np.int64)
        if n:
            at = np.where(at < 0, at - before, at)
            before += n
        parts += [at, parts[0]]
    return np.concatenate(parts), batch.column("words").flatten().cast(pa.string())


def bigram_counts(texts: DataFrame, core: int, end: int) -> np.ndarray:
    """Counts of number pairs over all texts: RARE, END, then the ``core`` first words; a text begins after an END."""
    size = core + 2
    number = np.full(end + 1, RARE, np.int64)
    number[:core], number[end] = np.arange(core) + 2, END

    def count(batches):
        total, held, n = np.zeros(size * size, np.int64), [], 0
        for batch in batches:
            x, _ = running_text(batch, end)
            ids = np.where(x < 0, RARE, number[np.maximum(x, 0)])
            held.append(ids[:-1] * size + ids[1:])
            n += len(ids)
            if n > 2_000_000:
                total += np.bincount(np.concatenate(held), minlength=size * size)
                held, n = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=size * size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"pair": at, "n": total[at]})

    summed = texts.select("ids", "words").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    matrix = np.zeros(size * size, np.int64)
    for r in summed.toLocalIterator():  # (core + 2)^2 rows at most
        matrix[r["pair"]] = r["n"]
    return matrix.reshape(size, size)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange_classes(bigrams: np.ndarray, classes: int, sweeps: int = 12) -> np.ndarray:
    """Class of each number: RARE and END keep classes of their own (0 and 1), the others get 2 .. classes + 1."""
    size = len(bigrams)
    of = np.array([RARE, END, *[2 + k % classes for k in range(size - 2)]], np.int64)
    n = classes + 2
    follow = np.zeros((size, n))  # word -> class after it
    before = np.zeros((size, n))  # word -> class before it
    for c in range(n):
        follow[:, c] = bigrams[:, of == c].sum(axis=1)
        before[:, c] = bigrams[of == c, :].sum(axis=0)
    pairs = np.zeros((n, n))
    for c in range(n):
        pairs[c] = follow[of == c].sum(axis=0)
    out_n, in_n = bigrams.sum(axis=1).astype(float), bigrams.sum(axis=0).astype(float)
    for _ in range(sweeps):
        moved = 0
        for w in range(2, size):
            if not out_n[w] and not in_n[w]:
                continue
            old, self_n = of[w], float(bigrams[w, w])
            r, left = follow[w].copy(), before[w].copy()
            r[old] -= self_n
            left[old] -= self_n
            pairs[old] -= r
            pairs[:, old] -= left
            pairs[old, old] -= self_n
            now = _xlogx(pairs)
            rows = _xlogx(pairs + r) - now
            cols = _xlogx(pairs + left[:, None]) - now
            d = np.diagonal(pairs)
            gain = (rows.sum(axis=1) - np.diagonal(rows) + cols.sum(axis=0) - np.diagonal(cols)
                    + _xlogx(d + r + left + self_n) - _xlogx(d))
            row_n, col_n = pairs.sum(axis=1) + left, pairs.sum(axis=0) + r  # of the classes without w
            gain -= _xlogx(row_n + out_n[w]) - _xlogx(row_n) + _xlogx(col_n + in_n[w]) - _xlogx(col_n)
            gain[:2] = -np.inf
            new = int(np.argmax(gain)) if gain.max() > gain[old] + 1e-6 else int(old)
            pairs[new] += r
            pairs[:, new] += left
            pairs[new, new] += self_n
            if new != old:
                moved += 1
                of[w] = new
                follow[:, old] -= bigrams[:, w]
                follow[:, new] += bigrams[:, w]
                before[:, old] -= bigrams[w, :]
                before[:, new] += bigrams[w, :]
        if not moved:
            break
    return of


def word_contexts(texts: DataFrame, shared, core: int, of: np.ndarray, n: int, most: int = 250_000) -> DataFrame:
    """(w, k, contexts): how often each word outside the core follows class ``slot`` or precedes class ``slot - n``, packed as
    count * 2 n + slot; one row for each word and time a task passes its counts on.

    Neighbours outside the core are of the class RARE. ``k`` is the word's number in the table, or -1.
    """
    end = len(shared.value)
    class_of = np.full(end + 1, RARE, np.int64)
    class_of[:core], class_of[end] = of[2:], END

    def packed(keys: np.ndarray) -> tuple[np.ndarray, pa.Array]:
        """Keys number * 2 n + slot -> the different numbers, and their contexts as binary values."""
        found, times = np.unique(keys, return_counts=True)
        number, contexts = found // (2 * n), (times * (2 * n) + found % (2 * n)).astype("<u4")
        at = np.flatnonzero(np.diff(number, prepend=-1))
        offsets = (4 * np.append(at, len(number))).astype("<i4")
        return number[at], pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(contexts)])

    def count(batches):
        keys, size, names, rare_keys, rare = [], 0, [], [], 0

        def rows():
            if size:
                number, contexts = packed(np.concatenate(keys))
                yield pa.RecordBatch.from_arrays([pa.array([shared.value[k] for k in number.tolist()], pa.string()), pa.array(number), contexts], ["w", "k", "contexts"])
            if rare:
                coded = pa.concat_arrays(names).dictionary_encode()
                place = np.concatenate(rare_keys)
                code = coded.indices.to_numpy().astype(np.int64)[place // (2 * n)]
                number, contexts = packed(code * (2 * n) + place % (2 * n))
                yield pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(number)), pa.array(np.full(len(number), -1)), contexts], ["w", "k", "contexts"])

        for batch in batches:
            x, found = running_text(batch, end)
            path = np.where(x < 0, RARE, class_of[np.maximum(x, 0)])
            known = np.flatnonzero((x >= core) & (x != end))
            keys += [x[known] * (2 * n) + path[known - 1], x[known] * (2 * n) + n + path[known + 1]]
            size += 2 * len(known)
            if len(found):
                at = np.flatnonzero(x < 0)
                name = rare - 1 - x[at]
                rare_keys += [name * (2 * n) + path[at - 1], name * (2 * n) + n + path[at + 1]]
                names.append(found)
                rare += len(found)
            if size > 4_000_000 or rare > most:
                yield from rows()
                keys, size, names, rare_keys, rare = [], 0, [], [], 0
        yield from rows()

    return texts.select("ids", "words").mapInArrow(count, "w string, k long, contexts binary")


def likeliest_classes(pairs: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """Of each word (a row of counts by slot), the class whose growth by the word's contexts raises the likelihood of the
    class bigrams ``pairs`` most; only classes that hold core words are asked (the first one if none does)."""
    n = len(pairs)
    rows = np.concatenate([pairs, pairs.T])  # slot -> counts with every class
    word, slot = np.nonzero(contexts)
    grown = _xlogx(rows[slot] + contexts[word, slot][:, None]) - _xlogx(rows)[slot]
    gain = np.add.reduceat(grown, np.flatnonzero(np.diff(word, prepend=-1)))
    c = contexts[:, :n].sum(axis=1, keepdims=True)  # a word follows and precedes as often as it occurs
    for margin in (pairs.sum(axis=1), pairs.sum(axis=0)):
        gain -= _xlogx(margin + c) - _xlogx(margin)
    held = pairs.sum(axis=0) > 0
    held[:2] = False
    if not held.any():
        held[2] = True
    gain[:, ~held] = -np.inf
    return gain.argmax(axis=1)


def assigned_classes(contexts: DataFrame, pairs: np.ndarray, at_once: int = 1000) -> DataFrame:
    """(w, k, class) of every word of ``contexts``; a word's rows meet in order, so a task holds about ``at_once`` words (and a batch)."""
    slots = 2 * len(pairs)

    def assign(batches):
        words, numbers, last, n_words = [], [], None, 0  # the open words: those of ``counts``
        where, packed, size, counts = [], [], 0, np.zeros(0)

        def fold():
            nonlocal where, packed, size, counts
            if where:
                x = np.concatenate(packed).astype(np.int64)
                now = np.bincount(np.concatenate(where) * slots + x % slots, x // slots, n_words * slots)
                now[:len(counts)] += counts
                where, packed, size, counts = [], [], 0, now

        def result(done: int):
            """The classes of the first ``done`` open words, which no later row is about."""
            w, k = pa.concat_arrays(words), pa.concat_arrays(numbers)
            found = likeliest_classes(pairs, counts.reshape(-1, slots)[:done])
            return pa.RecordBatch.from_arrays([w[:done], k[:done], pa.array(found.astype(np.int32))], ["w", "k", "class"]), w[done:], k[done:]

        for batch in batches:
            if not len(batch):
                continue
            w, raw = batch.column("w").cast(pa.string()), batch.column("contexts").cast(pa.binary())
            first = np.concatenate([[w[0].as_py() != last], pc.not_equal(w[1:], w[:-1]).to_numpy(zero_copy_only=False)]).astype(bool)
            offsets = np.frombuffer(raw.buffers()[1], "<i4")[raw.offset:raw.offset + len(raw) + 1]
            if first.any():
                words.append(w.filter(pa.array(first)))
                numbers.append(batch.column("k").filter(pa.array(first)))
            where.append(np.repeat(n_words - 1 + np.cumsum(first), np.diff(offsets) // 4))
            packed.append(np.frombuffer(raw.buffers()[2], "<u4", (offsets[-1] - offsets[0]) // 4, offsets[0]))
            size += len(packed[-1])
            n_words, last = n_words + int(first.sum()), w[-1].as_py()
            if size > 500_000 or n_words > at_once:
                fold()
            if n_words > at_once:
                out, *rest = result(n_words - 1)
                yield out
                words, numbers, n_words, counts = [rest[0]], [rest[1]], 1, counts[-slots:]
        if n_words:
            fold()
            yield result(n_words)[0]

    return contexts.repartition("w").sortWithinPartitions("w").mapInArrow(assign, "w string, k long, class int")


def class_pairs(texts: DataFrame, class_of: np.ndarray, n: int, classes: DataFrame, most: int = 250_000) -> np.ndarray:
    """Class bigrams of all training texts: a task adds up those of table words; the others meet their classes in joins."""
    end = len(class_of) - 1

    def count(batches):
        total, held, names, rare, columns = np.zeros(n * n, np.int64), [], [], 0, ["a", "b", "v", "w", "n"]

        def rows():
            at = np.flatnonzero(total)
            none = pa.array(np.full(len(at), "", object), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array((at // n).astype(np.int32)), pa.array((at % n).astype(np.int32)), none, none, pa.array(total[at])], columns)
            if not held:
                return
            # a word of a pair is its code (or none: the last place) and counts as class -1
            coded = pa.concat_arrays(names).dictionary_encode()
            code = np.append(coded.indices.to_numpy().astype(np.int64), len(coded.dictionary))
            left, right, v, w = (np.concatenate(x) for x in zip(*held))
            size = len(coded.dictionary) + 1
            # equal pairs of a word and a class, or of two words, as one number each
            key, times = np.unique((np.where(left < 0, n + code[v], left)) * (n + size) + np.where(right < 0, n + code[w], right), return_counts=True)
            left, right = key // (n + size), key % (n + size)
            known = pa.concat_arrays([coded.dictionary, pa.array([""], pa.string())])
            v, w = (known.take(pa.array(np.where(x < n, size - 1, x - n))) for x in (left, right))
            a, b = (pa.array(np.where(x < n, x, -1).astype(np.int32)) for x in (left, right))
            yield pa.RecordBatch.from_arrays([a, b, v, w, pa.array(times)], columns)

        for batch in batches:
            x, found = running_text(batch, end)
            path = np.where(x < 0, -1, class_of[np.maximum(x, 0)])
            left, right = path[:-1], path[1:]
            both = (left >= 0) & (right >= 0)
            total += np.bincount(left[both] * n + right[both], minlength=n * n)
            if len(found):
                at = np.flatnonzero(~both)
                v, w = (np.where(y < 0, rare - 1 - y, -1) for y in (x[at], x[at + 1]))
                held.append((left[at], right[at], v, w))
                names.append(found)
                rare += len(found)
            if rare > most:
                yield from rows()
                held, names, rare = [], [], 0
                total[:] = 0
        if held or total.any():
            yield from rows()

    summed = written(texts.select("ids", "words").mapInArrow(count, "a int, b int, v string, w string, n long")
                     .groupBy("a", "b", "v", "w").agg(F.sum("n").alias("n")), "pairs")
    of = classes.select(F.col("w").alias("_w"), F.col("class").alias("_c"))
    known = summed.filter("v = ''").select("a", "b", "w", "n").unionByName(
        summed.filter("v != ''").join(of, F.col("v") == F.col("_w")).select(F.col("_c").alias("a"), "b", "w", "n")
        .groupBy("a", "b", "w").agg(F.sum("n").alias("n")))
    known = known.filter("w = ''").select("a", "b", "n").unionByName(
        known.filter("w != ''").join(of, F.col("w") == F.col("_w")).select("a", F.col("_c").alias("b"), "n"))
    out = np.zeros((n, n))
    for r in known.groupBy("a", "b").agg(F.sum("n").alias("n")).collect():  # n^2 rows at most
        out[r["a"], r["b"]] = r["n"]
    return out


def folded(bigrams: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """Bigrams of numbers as bigrams of their ``n`` classes."""
    pairs = np.zeros((n, n))
    np.add.at(pairs, (of[:, None], of[None, :]), bigrams)
    return pairs


def path_score(transition: np.ndarray, left, right, found_at, found_class) -> float:
    """Sum of the transitions of class pairs; -1 - j stands for the row's rare word j, whose class is RARE unless found."""
    left, right = np.array(left, np.int64), np.array(right, np.int64)
    if not len(left):
        return 0.0
    of = np.full(1 + max(0, -int(min(left.min(), right.min()))), RARE, np.int64)
    of[np.array(found_at, np.int64)] = found_class
    left, right = (np.where(x < 0, of[np.maximum(-1 - x, 0)], x) for x in (left, right))
    return float(transition[left, right].sum())


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10, cluster_words: int = 800,
                classes: int = 48, table_words: int = 150_000, max_chars: int = 64, alpha: float = 0.1) -> DataFrame:
    """Per row: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    train = docs.filter(~held_out("id", folds))
    vocabulary = written(word_counts(train, "text"), "words")
    # a training text gives one end token
    ends = train.select("id").count()
    total, kinds = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("c")).first()
    train_tokens, distinct = total + ends, kinds + (1 if ends else 0)
    # about table_words entries of max_chars characters at most
    frequent = most_frequent(vocabulary.filter(F.length("w") <= max_chars), "w", "c", table_words)
    words = [w for w, _ in frequent]
    local = encoded(docs, words)
    train, end = local.filter(~held_out("id", folds)), len(words)
    k, n = min(cluster_words, end), classes + 2
    bigrams = bigram_counts(train, k, end)
    of = exchange_classes(bigrams, classes)
    contexts = word_contexts(train, spark.sparkContext.broadcast(words), k, of, n)
    others = written(assigned_classes(contexts, folded(bigrams, of, n)), "classes")
    number_class = np.full(end + 1, END, np.int64)  # the last place: the end
    number_class[:k] = of[2:]
    for r in others.filter("k >= 0").select("k", "class").collect():  # table_words rows at most
        number_class[r["k"]] = r["class"]
    rare_classes = others.filter("k < 0").select("w", "class")
    pairs = class_pairs(train, number_class, n, rare_classes)
    transition = np.log10((pairs + alpha) / (pairs.sum(axis=1, keepdims=True) + alpha * n))
    # tokens of each class; every training token is once the second of a pair
    class_log = np.log10(np.maximum(pairs.sum(axis=0), 1))
    floor = math.log10(train_tokens + 0.1 * (distinct + 1))

    c = np.array([m for _, m in frequent], np.float64)
    shared = spark.sparkContext.broadcast({
        "base": np.append(np.log10(c + 0.1) - floor, 0.0), "emission": np.append(np.log10(c) - class_log[number_class[:-1]], 0.0),
        "class": number_class, "transition": transition})
    end_base, end_emission = math.log10(ends + 0.1) - floor, float(math.log10(max(ends, 1)) - class_log[END])

    def make():
        base, emission, class_of, transition = (shared.value[x] for x in ("base", "emission", "class", "transition"))

        def score(raw: bytes):
            x = np.frombuffer(raw, "<i4")
            at = np.where(x < 0, end, x)  # the last place adds nothing
            path = np.concatenate([[END], np.where(x < 0, x, class_of[at]), [END]])
            left, right = path[:-1], path[1:]
            both = (left >= 0) & (right >= 0)
            return (len(x) + 1, int((x >= 0).sum()) + (ends > 0), float(base[at].sum()) + end_base,
                    float(emission[at].sum() + transition[left[both], right[both]].sum()) + end_emission, left[~both].tolist(), right[~both].tolist())

        return score

    def run(batches):
        transition = shared.value["transition"]
        for columns in batches:
            yield pd.Series([path_score(transition, *x) for x in zip(*columns)], dtype="float64")

    run.__annotations__ = {"batches": Iterator[tuple[pd.Series, ...]], "return": Iterator[pd.Series]}
    path_sum = F.pandas_udf(run, "double")
    part = per_text(make, "n_tokens long, known long, base double, score double, left array<int>, right array<int>")
    rare = local.select("row", F.posexplode(F.arrays_zip("words", "times")).alias("j", "x")).select(
        "row", "j", F.col("x.words").alias("w"), F.col("x.times").alias("m"))
    counts = vocabulary.join(rare_classes, "w").withColumn("total", F.element_at(F.array(*[F.lit(float(x)) for x in class_log]), F.col("class") + 1))
    log_c = F.log10(F.col("c") + 0.1)
    # words without a count: the one word of the rare class, with probability 1 in it
    sums = rare.join(counts, "w", "left").groupBy("row").agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("m")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("m") * (F.coalesce(log_c, F.lit(-1.0)) - floor)).alias("rare_base"),
        F.sum(F.col("m") * F.coalesce(F.log10("c") - F.col("total"), F.lit(0.0))).alias("rare_score"),
        F.collect_list(F.when(F.col("c").isNotNull(), F.struct("j", "class"))).alias("found"))
    zero = lambda x: F.coalesce(F.col(x), F.lit(0))
    some = lambda x: F.coalesce(F.col(x), F.array().cast("array<int>"))
    path = path_sum("left", "right", some("found.j"), some("found.class"))
    scored = local.select("row", "id", part(F.col("ids")).alias("r")).select("row", "id", "r.*")
    return scored.join(sums, "row", "left").select(
        F.col("id").alias(id_col), held_out("id", folds).alias("held_out"), "n_tokens",
        (F.col("known") + zero("rare_known")).cast("long").alias("n_known"), F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + zero("rare_base")).alias("base_score"), (F.col("score") + zero("rare_score") + path).alias("score"))
