import pytest
from pyspark.sql import types as T

from monthspan.sources import dictionary


def test_schema_of_the_monthly_files():
    schema = dictionary.monthly_schema()
    assert len(schema) == 20
    assert schema["LEASE_KID"].dataType == T.LongType()
    assert schema["PRODUCTION"].dataType == T.DoubleType()
    assert [f.name for f in schema if f.metadata["required"]] == ["LEASE_KID", "MONTH-YEAR", "PRODUCT"]
    assert dictionary.categories(schema) == {
        "TWN_DIR": ["S", "N"], "RANGE_DIR": ["E", "W"], "PRODUCT": ["O", "G"],
    }
    assert dictionary.archive_schema().names == [*schema.names, "URL"]


def test_unknown_label():
    with pytest.raises(ValueError, match="decimal"):
        dictionary.build_schema([("A", "decimal", "yes", "")])


def test_categories_are_trimmed():
    schema = dictionary.build_schema([("A", "categorical", "yes", " S | |N|")])
    assert schema["A"].metadata["categories"] == ["S", "N"]


def test_load(spark, tmp_path):
    path = tmp_path / "dictionary.csv"
    path.write_text(
        "column,description,dtype,nullable,categories,more\n"
        'A,"first, with ""quotes""",int,no,,x\n'
        "B,,categorical,yes,S|N,x\n"
    )
    rows = dictionary.load_dictionary(spark, str(path))
    assert list(rows[0]) == dictionary.DICTIONARY_COLUMNS
    assert rows[0]["description"] == 'first, with "quotes"'
    assert rows[1]["description"] == ""
    schema = dictionary.load_schema(spark, str(path))
    assert schema.names == ["A", "B"]
    assert schema["A"].metadata["required"] and not schema["B"].metadata["required"]


def test_load_without_a_column(spark, tmp_path):
    path = tmp_path / "dictionary.csv"
    path.write_text("column,dtype\nA,int\n")
    with pytest.raises(ValueError, match="nullable"):
        dictionary.load_dictionary(spark, str(path))
