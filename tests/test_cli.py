"""Every step of the command on small documents."""

import json

import pytest

from foliowright import cli

PAGES = [
    {"index": 0, "markdown": "HOUSE OF LORDS, MARTIS, 4° DIE FEBRUARII, 1834.\n\nMr. A. B.—The house of the lords met in the develop-", "image": [1]},
    {"index": 1, "markdown": "ment of tiie house. " + "the house of lords. " * 60 + "the houfe and aud the lordz"},
    {"index": 2, "markdown": "left out by a sample"},
]


@pytest.fixture
def given(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "v.json").write_text(json.dumps({"title": "T", "pages": PAGES}))
    (tmp_path / "w.txt").write_text("house\nlords\nthe\nof\nand\nmet\nin\ndevelopment\nby\na\n")
    (tmp_path / "d.aff").write_text("SFX S Y 1\nSFX S 0 s .\n")
    (tmp_path / "d.dic").write_text("3\nlord/S\nhouse/S\nthe\n")
    return tmp_path


def parts(folder):
    return "".join(p.read_text() for p in sorted(folder.rglob("part-*")))


def run(given, step, *options):
    cli.main([step, str(given / "in"), str(given / "out"), *options])
    return given / "out"


def test_headers(spark, given):
    out = json.loads(parts(run(given, "headers", "--sample", "2") / "volume=v"))
    assert out["title"] == "T" and len(out["pages"]) == 2 and out["pages"][0]["image"] == [1]
    assert out["pages"][0]["header"].startswith("HOUSE OF LORDS") and out["pages"][0]["markdown"].endswith("the development")


def test_discover_then_frequency(spark, given):
    report = run(given, "discover")
    found = json.loads("".join(parts(f) for f in sorted(report.iterdir())))
    assert {c["rare_word"]: c["suggested_correction"] for c in found["error_candidates"]}["houfe"] == "house"
    (given / "analysis.json").write_text(json.dumps(found))
    cli.main(["frequency", str(given / "in"), str(given / "fixed"), "--analysis", str(given / "analysis.json"), "--threshold", "0.8", "--report", str(given / "r")])
    assert "the house and aud" in json.loads(parts(given / "fixed" / "volume=v"))["pages"][1]["markdown"]
    told = json.loads("".join(parts(f) for f in sorted((given / "r").iterdir())))
    assert told["total_pages_processed"] == 3 and told["confidence_threshold"] == 0.8
    assert {"original": "houfe", "corrected": "house", "count": 1} in told["corrections_by_type"]


def test_confusion(spark, given):
    out = json.loads(parts(run(given, "confusion") / "volume=v"))
    assert "ment of the house." in out["pages"][1]["markdown"] and "and and the" in out["pages"][1]["markdown"]


def test_detect(spark, given):
    out = json.loads(parts(run(given, "detect", "--words", str(given / "w.txt"), "--threshold", "0.5", "--report", str(given / "errors")) / "volume=v"))
    assert "of the house" in out["pages"][1]["markdown"]
    records = [json.loads(line) for line in parts(given / "errors").splitlines()]
    # the vocabulary of close words is that of every tenth page
    assert {r["original_word"] for r in records} == {"tiie", "aud"} and all(PAGES[r["page_index"]]["markdown"][r["position"] :].startswith(r["original_word"]) for r in records)


def test_hybrid_with_an_affix_dictionary(spark, given):
    out = json.loads(parts(run(given, "hybrid", "--dictionary", str(given / "d"), "--words", str(given / "w.txt"), "--report", str(given / "r")) / "volume=v"))
    assert "the house and" in out["pages"][1]["markdown"] and "the lords" in out["pages"][1]["markdown"][-12:]


def test_speeches(spark, given):
    rows = [json.loads(line) for line in parts(run(given, "speeches")).splitlines()]
    assert rows[0]["id"] == "v_speech_000001" and rows[0]["house"] == "HOUSE OF LORDS" and rows[0]["date_iso"] == "1834-02-04"
