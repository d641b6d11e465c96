"""Spelling variants: words one letter apart, found by anagram hashing, and the form each points to.

A word's anagram key is the sum of a power of each of its letters, so the order of letters does not
matter and one letter more, less or exchanged changes the key by a value known beforehand. Two words
that are an exchange apart have one key once each has given up a letter; of two words that are an
addition apart the longer one has the other's key once it has given up a letter. So each word sends
its key, and its key less each of its letters; what meets in a join is verified letter by letter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import materialise

#: Runs of these letters; a shorter run than LEAST cannot become a word, as damage only takes letters away.
LETTERS = "A-Za-zÀ-ÿ"
LEAST, OFTEN = 5, 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One run in so many loses a letter, chosen by the run's hash.
DAMAGED = 97
#: The sum of fifth powers tells letters apart that add up to the same; it is taken modulo a prime, so that no length overflows.
POWER, PRIME = 5, (1 << 61) - 1
#: A key that more rows share is split by what is left of the word without the letter.
CROWDED = 64


def words(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", often: int = OFTEN) -> DataFrame:
    """word and n of every word of at least LEAST letters that occurs `often`, over whole texts.

    A null text has no words; a null id counts as empty text in the hash.
    """
    run = F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(f"[{LETTERS}]{{{LEAST},}}"), F.lit(0))).alias("run")
    runs = documents.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), run).select("id", F.translate("run", UPPER, LOWER).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat_ws(":", "id", "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    said = hashed.select(F.when(F.col("h") % DAMAGED == 0, less).otherwise(F.col("run")).alias("word"))
    return said.where(F.length("word") >= LEAST).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= often)


def _value(letter: Column) -> Column:
    code = F.ascii(letter).cast("long")
    out = code
    for _ in range(POWER - 1):
        out = out * code
    return out


def anagram_key(word: Column) -> Column:
    return F.aggregate(F.split(word, ""), F.lit(0).cast("long"), lambda total, letter: (total + _value(letter)) % PRIME)


def _sent(vocabulary: DataFrame) -> DataFrame:
    """key, letter given up (empty: none), word and n: a row for each word and each of its distinct letters."""
    letters = F.explode(F.concat(F.array(F.lit("")), F.array_distinct(F.split("word", "")))).alias("letter")
    keyed = vocabulary.select("word", "n", anagram_key(F.col("word")).alias("_key"), letters)
    less = F.pmod(F.col("_key") - _value(F.col("letter")), F.lit(PRIME))
    return keyed.select(F.when(F.col("letter") == "", F.col("_key")).otherwise(less).alias("key"), "letter", "word", "n")


def _pairs(rows: DataFrame, on: list[str]) -> DataFrame:
    """a, a_n, b, b_n of words one letter apart that share a key: each pair once a key."""
    a = rows.where("letter <> ''").select(*on, F.col("word").alias("a"), F.col("n").alias("a_n"))
    b = rows.select(*on, F.col("letter").alias("_b_letter"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    apart = F.levenshtein(F.col("a"), F.col("b"), 1) == 1
    return a.join(b, on).where(((F.col("_b_letter") == "") | (F.col("a") < F.col("b"))) & apart).select("a", "a_n", "b", "b_n")


def _without_letter(word: Column, letter: Column) -> Column:
    """What is left of the word without one of the places of the letter; the word itself for no letter."""
    places = F.filter(F.sequence(F.lit(1), F.length(word)), lambda i: F.substring(word, i, F.lit(1)) == letter)
    rests = F.transform(places, lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))))
    return F.when(letter == "", F.array(word)).otherwise(F.array_distinct(rests))


def near_pairs(vocabulary: DataFrame, *, crowded: int = CROWDED) -> DataFrame:
    """a, a_n, b, b_n: every pair of words that differ by one inserted, deleted or replaced letter, once.

    Keys that more than `crowded` rows share would pair words that are only made of like letters;
    their rows also carry what is left of the word, so that only true neighbours and words with a
    letter moved meet. A rest admits one letter a place, which bounds the pairs of a key.
    """
    sent = materialise(_sent(vocabulary), "keys")
    many = materialise(sent.groupBy("key").count().where(F.col("count") > crowded).select("key"), "crowded")
    usual = _pairs(sent.join(many, "key", "left_anti"), ["key"])
    rests = sent.join(many, "key", "left_semi").withColumn("rest", F.explode(_without_letter(F.col("word"), F.col("letter")))).withColumn("rest", F.xxhash64("rest"))
    return usual.unionByName(_pairs(rests, ["key", "rest"]).distinct())


def group_variants(documents: DataFrame, *, often: int = OFTEN, crowded: int = CROWDED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near and form_n of every word.

    form: the near word of largest n (of equal ones the smallest in code-point order) if that is at
    least twice the word's own, else null. root: the last of the forms from the word on, or the word.
    Null texts have no words, repeated rows count each, an empty table gives no rows, other columns
    are ignored.
    """
    vocabulary = materialise(words(documents, id_col=id_col, text_col=text_col, often=often), "words")
    near = near_pairs(vocabulary, crowded=crowded)
    both = near.select(F.col("a").alias("word"), F.col("b").alias("to"), F.col("b_n").alias("to_n")).unionByName(near.select(F.col("b").alias("word"), F.col("a").alias("to"), F.col("a_n").alias("to_n")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("to_n")).alias("less"), "to")).alias("best"))
    found = vocabulary.join(best, "word", "left")
    points = -F.col("best.less") >= 2 * F.col("n")
    found = found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(points, F.col("best.to")).alias("form"), F.when(points, -F.col("best.less")).alias("form_n"))
    found = materialise(found, "forms")
    return found.join(_roots(found), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(forms: DataFrame) -> DataFrame:
    """word and root of the words that have a form: every round looks twice as far ahead.

    n at least doubles with each form, so the way to a root is short and the rounds are few.
    """
    roots = forms.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = materialise(roots.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "roots")
        roots = moved.drop("_moved")
        if moved.where("_moved").isEmpty():
            return roots
