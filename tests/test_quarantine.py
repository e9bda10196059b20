import pytest

from threadmood import schemas
from threadmood.plans import run
from threadmood.sources import quarantine, readers

GOOD = [
    '{"id": "a", "body": "one", "created_utc": "10.0", "score": 3}',
    '{"id": "b", "body": null, "score": 4.0, "more": [1, {"x": 2}]}',
    "  ",
    '{"body": "no id", "created_utc": 7}',
]
BAD = {
    '{"id": "c", "body": "cut o': quarantine.NOT_JSON,
    "plain text": quarantine.NOT_JSON,
    "[1, 2]": quarantine.NOT_JSON,
    "7": quarantine.NOT_JSON,
    '{"id": "d", "score": "many"}': f"{quarantine.NOT_WHOLE}: score",
    '{"id": "e", "created_utc": 1.5, "score": "x"}': f"{quarantine.NOT_WHOLE}: created_utc",
    '{"id": "f", "score": 1e30}': f"{quarantine.NOT_WHOLE}: score",
}


@pytest.fixture
def lines(tmp_path):
    path = tmp_path / "comments.json"
    path.write_text("\n".join([*GOOD, *BAD, ""]), encoding="utf-8")
    return str(path)


def test_lines_that_do_not_fit_are_set_apart(spark, tmp_path, lines):
    found = readers.separate_json(spark, lines, schemas.COMMENTS, str(tmp_path / "q"))
    assert (found.n_rows, found.n_rejected) == (3, len(BAD))
    assert {r.record: r.reason for r in found.rejected.collect()} == BAD
    assert all(r.file.endswith("comments.json") for r in found.rejected.collect())
    rows = {(r.id, r.body, r.created_utc, r.score) for r in found.rows.collect()}
    assert rows == {("a", "one", 10, 3), ("b", None, None, 4), (None, "no id", 7, None)}
    assert found.rows.schema == schemas.COMMENTS


def test_a_finished_quarantine_is_left_alone_and_counted(spark, tmp_path, lines):
    first = readers.separate_json(spark, lines, schemas.COMMENTS, str(tmp_path / "q"))
    (tmp_path / "other.json").write_text("")
    again = readers.separate_json(spark, str(tmp_path / "other.json"), schemas.COMMENTS, str(tmp_path / "q"))
    assert (again.n_rows, again.n_rejected) == (first.n_rows, first.n_rejected)


def test_without_a_quarantine_a_broken_line_is_an_error(spark, lines, tmp_path):
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_json(spark, lines, schemas.COMMENTS).collect()
    rows = readers.read_json(spark, lines, schemas.COMMENTS, str(tmp_path / "q"))
    assert rows.count() == 3
    tokens = run.tokenize_json(spark, lines, keep=("id",), quarantine_path=str(tmp_path / "t"))
    # A line with a wrong number is no loss where the number is not read.
    assert tokens.where("id IS NOT NULL").count() == 5


def test_empty_input(spark, tmp_path):
    (tmp_path / "none.json").write_text("\n \n")
    found = readers.separate_json(spark, str(tmp_path / "none.json"), schemas.COMMENTS, str(tmp_path / "q"))
    assert (found.n_rows, found.n_rejected, found.rows.count(), found.rejected.count()) == (0, 0, 0, 0)


def test_csv_records_with_other_numbers_of_fields(spark, tmp_path):
    path = tmp_path / "labels.csv"
    records = ["labeldjt,Input_id,labeldem,labelgop,note", '1,a,-1.0,,"x, y"', "1,b", "0,c,1,1,n,m", "2,d,no,0,", ",e,,,"]
    path.write_text("\n".join(records) + "\n")
    found = readers.separate_labels(spark, str(path), str(tmp_path / "q"))
    assert {tuple(r) for r in found.rows.collect()} == {("a", -1, None, 1), ("e", None, None, None)}
    assert {(r.record, r.reason) for r in found.rejected.collect()} == {
        ("1,b", quarantine.FIELD_COUNT),
        ("0,c,1,1,n,m", quarantine.FIELD_COUNT),
        ("2,d,no,0,", f"{quarantine.NOT_WHOLE}: labeldem"),
    }
    for wrong in (records[2], records[3]):
        ragged = tmp_path / f"{len(wrong)}.csv"
        ragged.write_text(f"{records[0]}\n{wrong}\n")
        with pytest.raises(Exception, match=quarantine.FIELD_COUNT):
            readers.read_labels(spark, str(ragged)).count()
    assert readers.read_labels(spark, str(path), quarantine_path=str(tmp_path / "q")).count() == 2
