import pytest

from archives import PAGE, ordinary, record, write
from crawlcorpus.__main__ import main


def test_check_and_prefix(spark, tmp_path, capsys):
    path = write(tmp_path / "a.warc.gz", ordinary())
    main(["check", path])
    assert capsys.readouterr().out == f"{path}: OK: 5 records\n"
    (tmp_path / "lines").write_text("a/b/c\na/b/d\n")
    main(["common-prefix", f"{tmp_path}/lines"])
    main(["common-prefix", "-d", f"{tmp_path}/lines"])
    assert capsys.readouterr().out == "a/b/\na/b\n"


@pytest.mark.parametrize("options", [
    ["convert", "-s", "1.0"], ["hashes", "-n"], ["extract", "-i", "uuid:r"],
    ["sample", "--ratio", "1"], ["duplicates"]])
def test_jobs(spark, tmp_path, options):
    path = write(tmp_path / "a.warc.gz", ordinary() + [record("response", "r2", PAGE)])
    if options[0] == "duplicates":
        options = [*options, "--db", f"{tmp_path}/db"]
    main([options[0], path, "-o", f"{tmp_path}/out", *options[1:]])
    assert any((tmp_path / "out").iterdir())


def test_language_from_training_to_selection(spark, tmp_path):
    spark.createDataFrame([("en", "some bold text and head"), ("fi", "koira ja kissa")],
                          "lang string, text string").write.parquet(f"{tmp_path}/table")
    main(["train", f"{tmp_path}/table", "-o", f"{tmp_path}/model"])
    path = write(tmp_path / "a.warc.gz", ordinary())
    main(["select-language", path, "-m", f"{tmp_path}/model", "--label", "en", "--threshold", "0.5",
          "-o", f"{tmp_path}/out"])
    rows = "".join(f.read_text() for f in (tmp_path / "out").glob("*.csv")).splitlines()
    assert "urn:uuid:r\t4\t4\tTrue" in rows
    main(["sample", path, "--ratio", "1", "-l", "fi", "-m", f"{tmp_path}/model",
          "-o", f"{tmp_path}/none"])
    assert not list((tmp_path / "none").glob("*.warc.gz"))
