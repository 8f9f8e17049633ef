"""Splitting text into its distinct words."""
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

NOT_WORD = r"[^\p{L}\p{N}]+"


def distinct_words(text):
    """Array of the distinct lower-case words of a text column (built-ins only)."""
    parts = F.split(F.lower(text), NOT_WORD)
    return F.array_distinct(F.filter(parts, lambda word: word != ""))


def register_split_word(spark, name="split_word"):
    """Register the splitter as a table function for `LATERAL split_word(text)`."""
    pattern = NOT_WORD.replace("\\", "\\\\")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(txt STRING) RETURNS TABLE(word STRING) "
        f"RETURN SELECT explode(array_distinct(filter(split(lower(txt), '{pattern}'), w -> w <> '')))")
    return name


def segmenter_words(segment):
    """Wrap a word segmenter (text -> iterable of words) for use in `split_keyword`.

    Text moves to Python in Arrow batches; each row keeps its distinct words in
    first-seen order.
    """
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def words(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else list(dict.fromkeys(segment(t))))

    return words


def split_keyword(df, column, word="keyword", segmenter=None):
    """One row per distinct word of `column`; rows without words disappear."""
    words = segmenter_words(segmenter)(F.col(column)) if segmenter else distinct_words(F.col(column))
    return df.select("*", F.explode(words).alias(word)).drop(column)
