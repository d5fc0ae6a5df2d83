"""Benchmark decontamination as a prefix-filtered set join (built-in functions only).

Every window of ``WINDOW`` consecutive item words is a set that a document
must hold completely.  Its words are ordered by rarity in the corpus; as all
of them are necessary, a prefix of one word, the rarest, is enough to find
every document position at which the window can stand.  The join on that
word is followed, in the same stage, by the positional bounds (the window
must fit before and after the word), the length bound (it must not exceed
the document) and the exact comparison of the words in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.tables import materialize, stored, without_keys

WINDOW = 10
BROADCAST_WINDOWS = 100_000   # most windows that are sent to every task at once, some 50 MB
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = "".join(chr(c) for c in range(128) if not chr(c).isalnum())   # ASCII that is in no word
NO_WORD = "|"                 # stands for the document itself; no word has this character


def words_of(text: Column) -> Column:
    """Runs of digits, letters and non-ASCII characters, A-Z lower-cased; none for null."""
    spaced = F.translate(F.coalesce(text, F.lit("")), UPPER + BETWEEN, LOWER + " " * len(BETWEEN))
    return F.array_remove(F.split(spaced, " "), "")   # a regular expression for the words takes several times as long


def item_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``item_id, window`` (array of words): every run of ``size`` words, or all words of a shorter item."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("w"))
    items = items.filter("item_id is not null").filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    return items.select("item_id", F.explode(F.transform(starts, lambda s: F.slice("w", s, size))).alias("window")).distinct()


def rarity(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """``word, n``: how often each benchmark word occurs in all documents."""
    wanted = materialize(windows.select(F.explode("window").alias("word")).distinct())
    if wanted.count() <= BROADCAST_WINDOWS:
        wanted = F.broadcast(wanted)
    counted = (docs.select(F.explode(words_of(F.col("text"))).alias("word")).join(wanted, "word")
               .groupBy("word").agg(F.count("*").alias("n")))
    return materialize(counted)


def prefixes(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """``word, skip, window, item_ids``: each different window under its rarest
    word, which stands ``skip`` words after its first.  Windows with a word
    that no document has cannot occur and are left out."""
    sets = windows.groupBy("window").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    placed = sets.select("window", "item_ids", F.posexplode("window").alias("skip", "word"))
    known = placed.join(rarity(docs, windows), "word")
    whole = F.count("*").over(Window.partitionBy("window")) == F.size("window")
    order = Window.partitionBy("window").orderBy("n", "word", "skip")
    return materialize(known.withColumn("whole", whole).withColumn("rank", F.row_number().over(order))
                       .filter("whole and rank = 1").select("word", "skip", "window", "item_ids"))


def occurrences(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, key: str | None = None) -> DataFrame:
    """``row_id, doc_id, n_words`` of every document: one row of null ``begin,
    length, item_ids``, and one per place where a window occurs.

    The windows are broadcast; when there are more than
    ``BROADCAST_WINDOWS``, in several rounds of that many, each of which
    reads the documents once more.  Rows are told apart by the column ``key``,
    or else by numbers, which are written down first if they are read more than once.
    """
    found = prefixes(docs, item_windows(benchmark, size))
    rounds = max(1, -(-found.count() // BROADCAST_WINDOWS))
    itself = docs.sparkSession.range(1).select(
        F.lit(NO_WORD).alias("word"), F.lit(None).cast("int").alias("skip"),
        F.lit(None).cast("array<string>").alias("window"), F.lit(None).cast("array<string>").alias("item_ids"))
    texts = docs.select((F.col(key) if key else F.monotonically_increasing_id()).alias("row_id"), "doc_id", "text")
    texts = stored(texts, "numbered-texts") if rounds > 1 and not key else texts
    words = texts.select("row_id", "doc_id", F.concat(words_of(F.col("text")), F.array(F.lit(NO_WORD))).alias("w"))
    tokens = words.select("row_id", "doc_id", "w", F.posexplode("w").alias("at", "word"))
    fits = (F.col("at") >= F.col("skip")) & (F.col("at") - F.col("skip") + F.size("window") < F.size("w"))
    same = F.slice("w", F.col("at") - F.col("skip") + 1, F.size("window")) == F.col("window")
    out = None
    for k in range(rounds):
        table = found.filter(F.pmod(F.xxhash64("window"), F.lit(rounds)) == k)
        table = table.unionByName(itself) if k == 0 else table
        part = (tokens.join(F.broadcast(table), "word")
                .filter(F.col("window").isNull() | F.when(fits, same).otherwise(False))
                .select("row_id", "doc_id", (F.size("w") - 1).cast("long").alias("n_words"),
                        (F.col("at") - F.col("skip")).alias("begin"), F.size("window").alias("length"), "item_ids"))
        out = part if out is None else out.unionByName(part)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, key: str | None = None) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_hit, item_ids, contaminated``.

    ``n_hit`` counts the document words inside any occurrence of a window;
    ``item_ids`` lists the items with an occurring window, sorted as strings.
    Null text has no words; items without id or words have no window; items
    that repeat (same id) count once.  Rows that repeat an id stay separate.
    Extra columns are ignored; an empty table gives an empty result.
    """
    by_row = Window.partitionBy("row_id").orderBy(F.col("begin").asc_nulls_first(), "length")
    reach = F.max(F.col("begin") + F.col("length")).over(by_row.rowsBetween(Window.unboundedPreceding, -1))
    # Words that an occurrence adds: those after the furthest end so far.
    fresh = F.greatest(F.col("begin") + F.col("length") - F.greatest(F.col("begin"), F.coalesce(reach, F.lit(0))), F.lit(0))
    return (occurrences(docs, benchmark, size, key)
            .withColumn("fresh", F.when(F.col("begin").isNull(), 0).otherwise(fresh))
            .groupBy("row_id").agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
                                   F.sum("fresh").cast("long").alias("n_hit"),
                                   F.sort_array(F.array_distinct(F.flatten(F.collect_set("item_ids")))).alias("item_ids"))
            .select("doc_id", "n_words", "n_hit", "item_ids", (F.col("n_hit") > 0).alias("contaminated")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no window occurs.  Each row is judged by its text, by 128 bits of which it
    is known again, whatever its id; so no copy of the documents is written and no group is formed."""
    text_key = F.unhex(F.md5(F.coalesce(F.col("text"), F.lit(""))))
    found = occurrences(docs.select(text_key.alias("key"), F.lit(None).cast("long").alias("doc_id"), "text"), benchmark, size, key="key")
    keyed = docs.select(text_key.alias("key"), F.struct("*").alias("row"))
    return without_keys(keyed, found.filter("begin is not null").select(F.col("row_id").alias("key")).distinct())
