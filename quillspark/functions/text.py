"""Text functions as Spark columns: tokens, sentences, counts, n-grams and overlap.

Word lists and patterns below are fixed values.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values.
WORD = r"[A-Za-z0-9]+(?:['’][A-Za-z]+)?"
NUMBER = r"(?iU)\b(?:\d+(?:[.,]\d+)?|one|two|three|four|five|six|seven|eight|nine|ten)\b"
SENTENCE_END = r"(?U)(?<=[.!?])\s+"
FIRST_PERSON = ("i", "i'm", "i've", "me", "my", "mine", "we", "we're", "us", "our", "ours")
SECOND_PERSON = ("you", "you're", "you've", "your", "yours")
THIRD_PERSON = ("he", "she", "it", "they", "him", "her", "them", "his", "their", "theirs")
TRANSITIONS = ("although", "because", "but", "finally", "for example", "however", "instead", "meanwhile", "now", "so", "the truth is", "then", "therefore", "yet")
SLANG = ("gonna", "wanna", "gotta", "kinda", "sorta", "yeah", "okay", "ok", "dude", "literally")
EMOTIONAL = ("amazing", "angry", "awful", "brilliant", "cruel", "danger", "disaster", "fear", "hate", "horrible", "incredible", "love", "obscene", "pain", "shocking", "terrible", "worst", "best", "urgent", "threat")
IMPERATIVE_STARTERS = ("ask", "avoid", "build", "consider", "do", "don't", "follow", "get", "give", "imagine", "keep", "learn", "let", "look", "make", "remember", "save", "start", "stop", "take", "try", "use", "watch")


def let(value: Column, body) -> Column:
    """body(value) with value computed once: functions over arrays compute an expression anew for each element that uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(*words: str) -> Column:
    return F.array(*[F.lit(w) for w in words])


@F.pandas_udf(T.StringType())
def nfkc(text: pd.Series) -> pd.Series:
    """Compatibility composition; Spark has no built-in for it."""
    import unicodedata

    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def composed(text: Column) -> Column:
    """NFKC; ASCII texts are as it leaves them, so only others go to Python."""
    odd = text.rlike(r"[^\x00-\x7F]")
    return F.when(odd, nfkc(F.when(odd, text))).otherwise(text)


def clean(text: Column, compose: bool = True) -> Column:
    """NFKC, white space collapsed to single spaces and trimmed; inside functions over arrays, compose before and pass False."""
    return F.trim(F.regexp_replace(composed(text) if compose else text, r"(?U)\s+", " "))


def tokens(text: Column) -> Column:
    """ASCII words with an optional apostrophe suffix, the apostrophe straight."""
    return F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.replace(w, F.lit("’"), F.lit("'")))


def lower_tokens(text: Column) -> Column:
    return F.transform(tokens(text), F.lower)


def normalized(text: Column, compose: bool = True) -> Column:
    """The lower-case tokens of the composed text, with single spaces."""
    return F.array_join(lower_tokens(composed(text) if compose else text), " ")


def word_count(text: Column) -> Column:
    """Words between white space."""
    return F.size(F.filter(F.split(text, r"(?U)\s+"), lambda w: w != ""))


def sentences(text: Column) -> Column:
    """Parts after sentence ends that white space follows; an empty text has none."""
    own = F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
    return F.when(own == "", F.array().cast("array<string>")).otherwise(F.split(own, SENTENCE_END))


def sentence_count(text: Column) -> Column:
    return F.when(text == "", 0).otherwise(F.greatest(F.lit(1), F.size(F.split(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""), SENTENCE_END))))


def total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x)


def nearest_rank(ordered: Column, fraction: float) -> Column:
    """The value at place ceil(fraction * n) of an ordered array; null if it is empty."""
    n = F.size(ordered)
    return F.when(n > 0, F.element_at(ordered, F.greatest(F.lit(1), F.ceil(n * fraction)).cast("int")))


def sentence_statistics(parts: Column) -> Column:
    """count, mean (3 places), median, least, most and p90 of the sentences' token counts; sentences without tokens don't count."""
    return let(F.array_sort(F.filter(F.transform(parts, lambda s: F.size(tokens(s))), lambda n: n > 0)), _length_statistics)


def _length_statistics(lengths: Column) -> Column:
    n = F.size(lengths)
    middle = lambda k: F.element_at(lengths, k.cast("int"))
    median = (middle(F.floor((n + 1) / 2)) + middle(F.floor(n / 2) + 1)) / 2
    return F.struct(
        n.alias("count"),
        F.when(n > 0, F.round(total(lengths) / n, 3)).alias("mean_words"),
        F.when(n > 0, F.round(median, 3)).alias("median_words"),
        F.when(n > 0, F.element_at(lengths, 1)).alias("min_words"),
        F.when(n > 0, F.element_at(lengths, -1)).alias("max_words"),
        nearest_rank(lengths, 0.9).cast("double").alias("p90_words"),
    )


def vocabulary(words: Column) -> Column:
    """Counts of tokens and different tokens, type-token ratio, mean length and the share of tokens of 8 characters or more."""
    return let(words, _vocabulary)


def _vocabulary(words: Column) -> Column:
    n, kinds = F.size(words), F.size(F.array_distinct(words))
    share = lambda x, places: F.when(n > 0, F.round(x / n, places)).otherwise(0.0)
    return F.struct(
        n.alias("token_count"),
        kinds.alias("unique_token_count"),
        share(kinds, 4).alias("type_token_ratio"),
        share(total(F.transform(words, F.length)), 3).alias("average_token_characters"),
        share(F.size(F.filter(words, lambda w: F.length(w) >= 8)), 4).alias("long_word_share"),
    )


def count_in(words: Column, lexicon: Iterable[str]) -> Column:
    return F.size(F.filter(words, lambda w: w.isin(*lexicon)))


def person_usage(words: Column) -> Column:
    return F.struct(*[count_in(words, x).alias(f"{k}_person_count") for k, x in (("first", FIRST_PERSON), ("second", SECOND_PERSON), ("third", THIRD_PERSON))])


def matches_in(words: Column, lexicon: Iterable[str]) -> Column:
    """The different tokens of a lexicon, sorted."""
    return F.array_sort(F.array_intersect(F.array_distinct(words), words_of(*lexicon)))


def question_count(parts: Column, mark: str = "?") -> Column:
    return F.size(F.filter(parts, lambda s: F.contains(s, F.lit(mark))))


def imperative_count(parts: Column, starters: Iterable[str] = IMPERATIVE_STARTERS) -> Column:
    return F.size(F.filter(parts, lambda s: F.coalesce(F.try_element_at(lower_tokens(s), F.lit(1)).isin(*starters), F.lit(False))))


def density(count: Column, parts: Column) -> Column:
    return F.round(count / F.greatest(F.lit(1), F.size(parts)), 4)


def number_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(NUMBER))


def short_sentence_share(parts: Column, most: int = 8) -> Column:
    lengths = F.filter(F.transform(parts, lambda s: F.size(tokens(s))), lambda n: n > 0)
    return let(lengths, lambda x: _short_share(x, most))


def _short_share(lengths: Column, most: int) -> Column:
    return F.when(F.size(lengths) > 0, F.round(F.size(F.filter(lengths, lambda n: n <= most)) / F.size(lengths), 4)).otherwise(0.0)


def transition_markers(text: Column, phrases: Iterable[str] = TRANSITIONS) -> Column:
    """(transition, count) of the phrases that occur, by phrase."""
    found = [F.struct(F.lit(p).alias("transition"), F.regexp_count(F.lower(text), F.lit(rf"(?U)\b{p}\b")).alias("count")) for p in sorted(phrases)]
    return F.filter(F.array(*found), lambda x: x["count"] > 0)


def repeated_tokens(df: DataFrame, key: str, text: str, least: int = 3, length: int = 4) -> DataFrame:
    """(key, token, n): tokens of length or more characters that a text has least times or more."""
    words = df.select(key, F.explode(lower_tokens(F.col(text))).alias("token")).where(F.length("token") >= length)
    return words.groupBy(key, "token").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def ngrams(words: Column, n: int) -> Column:
    """The different n-grams as strings."""
    gram = lambda own: F.transform(F.sequence(F.lit(1), F.greatest(F.size(own) - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(own, i, n), " "))
    return let(words, lambda own: F.when(F.size(own) >= n, F.array_distinct(gram(own))).otherwise(F.array().cast("array<string>")))


def overlap_share(candidate: Column, source: Column) -> Column:
    """Share of the candidate's n-grams that the source has too; 0 if it has none."""
    return F.when(F.size(candidate) > 0, F.size(F.array_intersect(candidate, source)) / F.size(candidate)).otherwise(0.0)


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_union(a, b))
    return F.when(both > 0, F.size(F.array_intersect(a, b)) / both).otherwise(0.0)


def longest_run(a: list[str], b: list[str]) -> tuple[int, int]:
    """(tokens, end in b) of the longest run of tokens that both have; the first by its end in a, then in b."""
    where: dict[str, list[int]] = {}
    for j, w in enumerate(b):
        where.setdefault(w, []).append(j)
    best, end, runs = 0, 0, {}
    for w in a:
        now = {}
        for j in where.get(w, ()):
            now[j] = runs.get(j - 1, 0) + 1
            if now[j] > best:
                best, end = now[j], j + 1
        runs = now
    return best, end


@F.pandas_udf(T.StructType().add("token_count", "integer").add("phrase", "string"))
def longest_common_phrase(left: pd.Series, right: pd.Series) -> pd.DataFrame:
    """The longest token run that two arrays of tokens share."""
    rows = []
    for a, b in zip(left, right):
        b = [] if b is None else list(b)
        n, end = longest_run([] if a is None else list(a), b)
        rows.append((n, " ".join(b[end - n : end])))
    return pd.DataFrame(rows, columns=["token_count", "phrase"])


@F.pandas_udf(T.IntegerType())
def longest_common_run(left: pd.Series, right: pd.Series) -> pd.Series:
    """The tokens of the longest run that two texts of tokens with single spaces share; null as empty."""
    rows, last = [], None
    for a, b in zip(left, right):
        if last is None or last[:2] != (a, b):  # variants of a record often have the same texts
            x, y = (a or "").split(" "), (b or "").split(" ")
            both = set(x) & set(y) - {""}
            last = (a, b, longest_run([w if w in both else None for w in x], [w if w in both else "" for w in y])[0] if both else 0)
        rows.append(last[2])
    return pd.Series(rows, dtype="int32")


# What counts as a named concept, and the words that don't.
CONCEPT = r"(?U)\b(?:[A-Z][A-Za-z]+(?:\s+[A-Z][A-Za-z]+){0,2}|[A-Z]{2,})\b"
NO_CONCEPTS = ("Let", "Well", "Okay", "What", "So", "And", "But", "The", "I", "You", "He", "She", "It", "They", "We", "This", "That")


def named_concepts(text: Column, stop: Iterable[str] = NO_CONCEPTS, most: int = 8) -> Column:
    """Runs of up to three capitalised words and words in capitals, the first of each spelling without regard to case, at most so many."""
    found = F.regexp_extract_all(text, F.lit(CONCEPT), F.lit(0))
    found = F.filter(found, lambda w: ~w.isin(*stop))
    first = F.aggregate(found, F.array().cast("array<string>"), lambda seen, w: F.when((F.size(seen) >= most) | F.exists(seen, lambda x: F.lower(x) == F.lower(w)), seen).otherwise(F.array_append(seen, w)))
    return F.slice(first, 1, most)


def mean_confidence(words: Column) -> Column:
    """The mean confidence of recognised words (structs with confidence) to four places; null if none has one."""
    known = F.filter(F.transform(words, lambda w: w["confidence"].cast("double")), lambda c: c.isNotNull())
    total = F.aggregate(known, F.lit(0.0), lambda a, c: a + c)
    return F.when(F.size(known) > 0, F.round(total / F.size(known), 4))
