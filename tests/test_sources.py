import csv

import pytest

from lagline.queries import load_all
from lagline.queries import tables as query_tables
from lagline.sources import delimited, records, tables
from lagline.sources.prepared import read_prepared

TEXT = " id ;name;größe\n1;Zoë;2,5\n2;Ana;3,5\n"


@pytest.mark.parametrize("encoding", ["utf-8", "latin-1", "utf-16"])
@pytest.mark.parametrize("delimiter", [";", ",", "\t"])
def test_probe_and_read(spark, tmp_path, encoding, delimiter):
    text = TEXT.replace(",", ".").replace(";", delimiter)
    path = tmp_path / "in.csv"
    path.write_bytes(text.encode(encoding))
    found = delimited.probe(spark, str(path), ["utf-8", "utf-16"] if encoding == "utf-16" else ["utf-8", "latin-1"])
    assert (found.encoding, found.delimiter) == (encoding, delimiter)
    df = delimited.read_delimited(spark, str(path), dialect=found)
    assert df.columns == ["id", "name", "größe"]
    assert [tuple(r) for r in df.orderBy("id").collect()] == [(1, "Zoë", 2.5), (2, "Ana", 3.5)]


def test_character_cut_by_the_probe(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_bytes("a;b\nöö;1\n".encode())
    assert delimited.probe(spark, str(path), probe_bytes=5).encoding == "utf-8"


def test_nothing_fits(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_bytes(b"single\nvalue\n")
    assert delimited.probe(spark, str(path)) == delimited.Dialect("latin-1", ";")


def test_missing_inputs(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        delimited.probe(spark, str(tmp_path / "none.csv"))
    with pytest.raises(FileNotFoundError):
        read_prepared(spark, str(tmp_path / "none"))


def test_json_objects(spark, tmp_path):
    values = {"metric": "manhattan", "n_neighbors": 15, "score": 0.5}
    delimited.write_json(spark, values, str(tmp_path / "p"))
    assert delimited.read_json_object(spark, str(tmp_path / "p")) == values


def test_late_bytes_decide_the_encoding(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_bytes(b"id;name\n" + b"".join(b"%d;plain name\n" % i for i in range(8000)) + "8000;Jos\u00e9\n".encode("latin-1"))
    df = delimited.read_delimited(spark, str(path))
    assert df.where("id = 8000").first()["name"] == "Jos\u00e9" and df.count() == 8001


def test_doubled_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('id,text\n1,"she said ""yes, now"""\n\n2,"two\nlines"\n')
    df = delimited.read_delimited(spark, str(path))
    assert {r["id"]: r["text"] for r in df.collect()} == {1: 'she said "yes, now"', 2: "two\nlines"}
    assert dict(df.dtypes) == {"id": "int", "text": "string"}


@pytest.fixture
def small_splits(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("encoding", ["utf-8", "latin-1", "cp1252"])
def test_quoted_text_over_many_splits(spark, tmp_path, small_splits, encoding, end):
    """Records over split borders, over whole splits, and a header longer than a split, in several files."""
    odd = "é" if encoding != "cp1252" else "é € “x” …"
    values = [f'{odd} line{end}"{i}",{end}' * (i % 7) + "end" for i in range(300)]
    values[100] = ("long " * 50 + end) * 60
    values[200] = end
    for name, part in (("a", range(0, 150)), ("b", range(150, 300))):
        rows = [["id", "the " + end + "text " * (800 if name == "a" else 1), "n"], *[[i, values[i], i / 2] for i in part]]
        with open(tmp_path / f"{name}.csv", "w", encoding=encoding, newline="") as f:
            csv.writer(f, lineterminator=end).writerows(rows)
    found = delimited.Dialect(encoding, ",")
    assert records.lines(spark, str(tmp_path)).rdd.getNumPartitions() > 15
    df = delimited.read_delimited(spark, str(tmp_path), "id int, text string, n double", found)
    got = {r["id"]: (r["text"], r["n"]) for r in df.collect()}
    assert df.count() == 300 and got == {i: (v, i / 2) for i, v in enumerate(values)}


def test_late_cp1252_bytes(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_bytes("id;price €\n1;5 €\n2;“x”\n".encode("cp1252"))
    df = delimited.read_delimited(spark, str(path), dialect=delimited.Dialect("cp1252", ";"))
    assert {r[0]: r["price €"] for r in df.collect()} == {1: "5 €", 2: "“x”"}


def test_unclosed_quote_takes_the_rest(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('a,b\n1,x\n2,"open\n3,y\n')
    rows = delimited.read_delimited(spark, str(path), "a int, b string").collect()
    assert {r["a"]: r["b"] for r in rows} == {1: "x", 2: "open\n3,y"}


def test_quoted_text_is_read_by_lines(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('a,b\n1,"x\ny"\n')
    plan = delimited.read_delimited(spark, str(path), "a int, b string")._jdf.queryExecution().toString()
    assert "multiLine" not in plan


def test_staged_lines_are_joined_once(spark, sf, capsys):
    columns = [*tables.LINE_KEY, "sales", "market", "late"]
    lines = tables.staged_lines(spark, sf, columns)
    lines.explain()
    assert "Join" not in capsys.readouterr().out
    assert sorted(lines.collect()) == sorted(tables.order_lines(spark, sf, columns).collect())


@pytest.mark.parametrize("query", ["s1_quoted_text", "s1_late_bytes"])
def test_no_task_writes_all_quoted_text(spark, tmp_path, small_splits, monkeypatch, query):
    rows = [(i, f"s{i % 3}", f'line {i}\nand "more" of it\r\n' + "x" * (i % 700)) for i in range(400)]
    spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(12).write.parquet(f"{tmp_path}/documents.parquet")
    written = []
    path = query_tables.scratch_path
    monkeypatch.setattr(query_tables, "scratch_path", lambda *given: written.append(path(*given)) or written[-1])
    got = load_all()[query].run(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == rows
    assert spark.read.format("binaryFile").load(written[0]).count() > 1
