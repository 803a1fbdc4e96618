import pytest

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
HARD = [
    (1, "one two three four five six seven eight nine ten eleven twelve", "en", "a", 1),
    (2, "One two THREE four five six seven eight nine ten eleven twelve", "en", "a", 1),
    (3, None, "en", "b", None),
    (4, "", None, "b", 0),
    (5, " \t\n\x0b\x0c\r ", "en", None, 7),
    (6, "two words", "de", "a", 9),
    (7, "two words", "de", "a", 9),
    (8, "Größe ÉTÉ naïve x́ \U0001f600 a\xa0b 'tis it's 12,5 <|endoftext|>\x1c z", "de", "a", 9),
    (9, "the same line again\nthe same line again\n\nthe same line again\n", "en", "a", 9),
    (10, "### !!! *** ||| SHOUT SHOUT SHOUT SHOUT SHOUT SHOUT SHOUT SHOUT", "en", "a", 9),
    (11, "word " * 30_000, "en", "long", 150_000),
    (12, "lone", "xx", "a", 4),
    (12, "lone", "xx", "a", 4),
    (None, "without an id", "en", "a", 4),
]


@pytest.fixture
def hard(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns whose names clash."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(HARD, SCHEMA)
    clash = ["score", "shard", "slot", "_target", "_order", "_gone", "_alone", "_found", "n", "h", "w", "salt", "token", "failed", "quality"]
    return df.withColumns({c: F.lit("kept") for c in clash})


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def tokenizer_path():
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def whole_ids(text):
    """Ids by the tokenizer over the whole text."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path()).encode(text or "", add_special_tokens=False).ids
