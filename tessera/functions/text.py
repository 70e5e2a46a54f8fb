"""Text normalization as Catalyst expressions. Only NFKC of non-ASCII text leaves the JVM, in Arrow batches."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Fixed values.
LEGAL_FORMS = [
    "inc", "incorporated", "corp", "corporation", "co", "company", "llc", "l l c", "ltd", "limited", "llp", "l l p", "pllc",
    "pc", "plc", "pvt", "private", "pvtltd", "sarl", "sas", "sasu", "eurl", "sa", "sci", "fils", "dba",
]
ABBREVIATIONS = {
    "rd": "road", "st": "street", "str": "street", "ave": "avenue", "av": "avenue", "blvd": "boulevard", "dr": "drive", "ln": "lane", "ct": "court", "pl": "place",
    "sq": "square", "hwy": "highway", "pkwy": "parkway", "apt": "apartment", "bldg": "building", "fl": "floor", "ste": "suite", "no": "number", "po": "po", "hno": "house number",
}
TRAILING_URL = r"\|\s*www\.\S+$"
LEADING_NOISE = r"^[\-\#\<\>\|\*\.\s]+"
URL_SUFFIX = r"(?i)\.(com|in|co|org|net|fr)(?![\p{L}\p{N}_])"
PUNCTUATION = r"[^\p{L}\p{N}_\s&]"


@F.pandas_udf(StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


def nfkc(c: Column) -> Column:
    """Compatibility composition; ASCII text passes unchanged without leaving the JVM's value, as it is its own NFKC form."""
    return F.when(c.rlike(r"^[\x00-\x7F]*$"), c).otherwise(_nfkc(c))


def word_tokens(c: Column) -> Column:
    """White-space separated tokens, none empty."""
    return F.filter(F.split(c, r"\s+"), lambda t: t != "")


def consecutive_distinct(tokens: Column) -> Column:
    """a a b a -> a b a. Each token is zipped with its predecessor, so that the lambda holds no outer expression."""
    zipped = F.arrays_zip(tokens.alias("t"), F.concat(F.array(F.lit(None).cast("string")), tokens).alias("p"))
    kept = F.filter(zipped, lambda z: z["t"].isNotNull() & ~z["t"].eqNullSafe(z["p"]))
    return F.transform(kept, lambda z: z["t"])


def blank_punctuation(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), PUNCTUATION, " ")


def strip_legal_forms(c: Column) -> Column:
    forms = "|".join(sorted(LEGAL_FORMS, key=lambda f: (-len(f), f)))
    return F.regexp_replace(c, rf"(?<![\p{{L}}\p{{N}}_])(?:{forms})(?![\p{{L}}\p{{N}}_])", " ")


def normalize_name(c: Column, compose: bool = True) -> Column:
    """Business name: null is empty; `compose=False` takes text that is known to be in NFKC already."""
    s = F.coalesce(c, F.lit(""))
    s = nfkc(s) if compose else s
    s = F.regexp_replace(F.regexp_replace(s, TRAILING_URL, ""), LEADING_NOISE, "")
    s = F.regexp_replace(F.replace(s, F.lit("&"), F.lit(" and ")), URL_SUFFIX, "")
    return F.array_join(consecutive_distinct(word_tokens(strip_legal_forms(blank_punctuation(s)))), " ")


def expand_abbreviations(tokens: Column) -> Column:
    table = F.create_map(*(F.lit(x) for pair in ABBREVIATIONS.items() for x in pair))
    return F.transform(tokens, lambda t: F.coalesce(F.try_element_at(table, t), t))


def normalize_address(c: Column, compose: bool = True) -> Column:
    s = F.coalesce(c, F.lit(""))
    s = F.regexp_replace(nfkc(s) if compose else s, LEADING_NOISE, "")
    return F.array_join(consecutive_distinct(expand_abbreviations(word_tokens(blank_punctuation(s)))), " ")


def normalize_country(c: Column) -> Column:
    return F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), r"^\s+|\s+$", ""))


def country_slug(c: Column) -> Column:
    slug = F.regexp_replace(normalize_country(c), r"[^a-z0-9]+", "_")
    return F.when(slug == "", F.lit("unknown")).otherwise(slug)


def blocking_tokens(name: Column, address: Column) -> Column:
    """Name tokens, then address tokens."""
    return F.concat(word_tokens(name), word_tokens(address))


def with_normalized(df: DataFrame, name: str = "business_name", address: str = "business_address", country: str = "country", compose: bool = True) -> DataFrame:
    if compose:  # once for each text, as a column of its own
        df = df.withColumns({"_n": nfkc(F.col(name)), "_a": nfkc(F.col(address))})
        out = with_normalized(df, "_n", "_a", country, compose=False)
        return out.drop("_n", "_a")
    out = df.withColumns({"norm_name": normalize_name(F.col(name), compose), "norm_address": normalize_address(F.col(address), compose), "norm_country": normalize_country(F.col(country))})
    return out.withColumn("blend_text", F.trim(F.concat_ws(" ", "norm_name", "norm_address")))


def parse_ids(c: Column) -> Column:
    """Comma-separated ids without empty parts."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), ","), lambda x: x != "")


def format_ids(c: Column) -> Column:
    return F.array_join(F.array_sort(c), ",")
