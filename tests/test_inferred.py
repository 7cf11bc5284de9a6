"""JSON without a schema."""

import json

import pytest

from brindle.sources import infer_json
from brindle.plans import shared_dir
from brindle.sinks import write_text


@pytest.fixture
def written(spark):
    def make(*files):
        paths = []
        for lines in files:
            paths.append(shared_dir(spark, "json"))
            write_text(spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1), paths[-1])
        return paths

    return make


def fields(found):
    return {r["field"]: (tuple(r["kinds"]), r["type"], r["conflict"], r["lines"]) for r in found.fields.collect()}


def test_files_that_do_not_agree(spark, written):
    first = [json.dumps({"id": i, "code": i, "n": i}) for i in range(5)]
    last = [json.dumps({"id": 9, "code": "x9", "n": 1.5}), json.dumps({"id": 10, "note": "only here", "code": None})]
    found = infer_json(spark, written(first, last))
    seen = fields(found)
    assert seen["code"] == (("BIGINT", "STRING"), "STRING", True, 7)
    assert seen["note"] == (("STRING",), "STRING", False, 1)
    assert seen["id"][:1] == (("BIGINT",),) and not seen["n"][2]
    assert found.rows.columns == ["code", "id", "n", "note"] and found.rejects.count() == 0
    rows = {r["id"]: r for r in found.rows.collect()}
    assert (rows[0]["code"], rows[9]["code"], rows[10]["code"], rows[10]["note"]) == ("0", "x9", None, "only here")
    assert float(rows[9]["n"]) == 1.5 and float(rows[3]["n"]) == 3.0


def test_lines_that_are_no_objects(spark, written):
    odd = ['{"a": 1', "", "[1, 2]", '"text"', "null", "7", "not json"]
    found = infer_json(spark, written(['{"a": 1}', "{}", *odd]))
    assert sorted(r["line"] for r in found.rejects.collect()) == sorted(odd)
    assert sorted(r["a"] for r in found.rows.collect() if r["a"] is not None) == [1] and found.rows.count() == 2


def test_nested_and_null_fields(spark, written):
    lines = [{"o": {"x": 1, "y": "t"}, "l": [1, 2], "n": None, "b": True}, {"o": {"z": 2.5}, "l": [], "n": None, "b": None}]
    found = infer_json(spark, written([json.dumps(line) for line in lines]))
    seen = fields(found)
    assert seen["n"][1:3] == ("STRING", False) and seen["b"][1] == "BOOLEAN" and seen["o"][1].startswith("STRUCT<") and seen["l"][1] == "ARRAY<BIGINT>"
    first = found.rows.where("b").first()
    assert (first["o"]["x"], first["o"]["y"], first["o"]["z"], first["l"], first["n"]) == (1, "t", None, [1, 2], None)


def test_odd_names(spark, written):
    found = infer_json(spark, written([json.dumps({"it's": 1, "a.b": 2, "c d": 3, "$": 4, "both ' and \"": 5, "[0]": 6})]))
    assert found.rows.first().asDict() == {"it's": 1, "a.b": 2, "c d": 3, "$": 4, "both ' and \"": 5, "[0]": 6}


def test_too_many_fields(spark, written):
    with pytest.raises(ValueError):
        infer_json(spark, written([json.dumps({f"k{i}": i for i in range(9)})]), most_fields=8)
