"""Inputs shared by the tests: awkward tables and small tables on disk."""

import pytest

AWKWARD = [
    (1, "One line that is long enough to be counted as a line of its own.\nshort", "en"),
    (2, "one line that is long enough to be counted as a line of its own. \nother", "en"),
    (2, "one line that is long enough to be counted as a line of its own. \nother", "en"),  # a repeated row
    (3, None, "en"),
    (4, "", "de"),
    (5, "  \n\t\n", None),
    (None, "ONE LINE THAT IS LONG ENOUGH TO BE COUNTED AS A LINE OF ITS OWN.", "fr"),
    (7, "word " * 60_000, "en"),  # very long
    (8, "Größe ñandú ÉÉ 漢字 🙂\x1c\x00 <|endoftext|> 'll", "xx"),
]


@pytest.fixture(scope="session")
def ready(spark):
    """The session with the package shipped to the workers."""
    from chronogrid.session import ship_package
    ship_package(spark)
    return spark


@pytest.fixture
def awkward(ready):
    """Nulls in every column, empty and long texts, a repeated row and clashing names."""
    rows = [(i, t, lang, "n", 1, 0.5, True) for i, t, lang in AWKWARD]
    return ready.createDataFrame(rows, "doc_id long, text string, lang string, n_lines string, shard int, score double, _row boolean")


@pytest.fixture
def tables(ready, tmp_path):
    """Writes tables to a folder of their own: name -> (rows, schema)."""
    def write(**made):
        for name, (rows, schema) in made.items():
            ready.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)
    return write
