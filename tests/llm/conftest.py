import random

import pytest

SF = "/root/testdata/sf0.001"


def odd_texts() -> list[str | None]:
    """Nulls, empty and long texts, ties, copies, near copies, personal data and strange characters."""
    r = random.Random(5)
    words = [f"w{r.randrange(3000)}" for _ in range(400)]
    near = words[:]
    near[200] = "other"
    cards = "pay by card 4111 1111 1111 1111 or 4111-1111-1111-1112, call +49 (30) 1234-567 now +1"
    mails = "write to a@b.c_d@e.f x.y+z@mail.example.com. 1.2.3.4.5 300.1.1.1 0010.2.3.255 a@b"
    iban = "Bank DE89 3704 0044 0532 0130 00, GB82WEST12345698765432 and GB82WEST12345698765431 visa 378282246310005"
    return [
        None, "", " ", "\n\n", "one", "Ünïcode ςΣ İ 日本語 <|endoftext|> x<|startoftext|>y \x1c\x85\xa0 '́e ǅ",
        " ".join(words), " ".join(words), " ".join(words), " ".join(near), " ".join(words).upper(), "\t".join(words),
        cards, mails, iban, "😀" * 3 + cards + mails + iban, (cards + "\n") * 700, "a" * 20_000, "12 " * 9_000, "x.y " * 2_000 + "q@" * 3_000,
        "the same line\n" * 40, "### *** $$$ &&& " * 50, "tie", "tie", "tie",
    ]


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "6g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows in the shape of ``documents``, with further columns whose names clash with outputs."""
    rows = [(i, t, "en", "s", 1, 7, "k", 3) for i, t in enumerate(odd_texts())]
    rows += [rows[6], rows[6], (None, "no identifier", None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, n_tokens long, node string, rank long"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")
