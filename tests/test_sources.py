import os
import random

import pytest

from quarry.sinks import lines as sk
from quarry.sources import files as src


def _write(path, text, enc="utf-8"):
    with open(path, "w", encoding=enc) as f:
        f.write(text)


def test_csv_quoted_comma_and_dropmalformed(spark, tmp_dir):
    p = os.path.join(tmp_dir, "t.csv")
    _write(p, 'id,Nom_parc,n\n1,"AHUNTSIC, PARC",3\n2,,4\n3,bad,notanumber\n4,"",5\n')
    df = src.scan_csv(spark, p, "id INT, Nom_parc STRING, n INT", exact_drops=True)
    rows = sorted((r.id, r.Nom_parc) for r in df.collect())
    assert rows == [(1, "AHUNTSIC, PARC"), (2, None), (4, None)]


def test_skip_header_drops_only_first_line_per_file(spark, tmp_dir):
    d = os.path.join(tmp_dir, "lines")
    os.makedirs(d)
    _write(os.path.join(d, "a.txt"), "h\nx\nh\ny\n")
    _write(os.path.join(d, "b.txt"), "h\nz\n")
    got = sorted(r.value for r in src.skip_header(src.scan_text(spark, d)).collect())
    assert got == ["h", "x", "y", "z"]


def test_parse_delimited_strict_and_lenient(spark, tmp_dir):
    p = os.path.join(tmp_dir, "r.txt")
    _write(p, "0::2::3::1424380312\n1::5::4.5::0\n2::x::1::0\n")
    lines = src.scan_text(spark, p)
    lenient = src.parse_delimited(lines, ["u", "m", "r"], ["long", "long", "double"], lenient=True)
    assert sorted(tuple(r) for r in lenient.collect()) == [(0, 2, 3.0), (1, 5, 4.5), (2, None, 1.0)]
    strict = src.parse_delimited(lines, ["u", "m", "r"], ["long", "long", "double"])
    with pytest.raises(Exception):
        strict.collect()


def test_parse_ragged_keeps_file_order(spark, tmp_dir):
    p = os.path.join(tmp_dir, "plants.data")
    _write(p, "abelia,fl,nc\nabies,ak\nsolo\n")
    got = {r.key: list(r.items) for r in src.parse_ragged(src.scan_text(spark, p)).collect()}
    assert got == {"abelia": ["fl", "nc"], "abies": ["ak"], "solo": []}


def test_file_order_row_index(spark, tmp_dir):
    from quarry.operators.indexing import row_index

    p = os.path.join(tmp_dir, "big.txt")
    _write(p, "".join(f"line{i}\n" for i in range(3000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = src.scan_text(spark, p)
        assert lines.rdd.getNumPartitions() > 1
        got = {r.value: r.idx for r in row_index(lines).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {f"line{i}": i for i in range(3000)}


def test_to_csv_lines_format(spark):
    df = spark.createDataFrame([("AHUNTSIC, PARC", 77, ["fl", "nc"], None, True)],
                               "p STRING, c LONG, items ARRAY<STRING>, x STRING, b BOOLEAN")
    assert sk.to_csv_lines(df).first().line == "AHUNTSIC, PARC,77,['fl', 'nc'],None,True"
    empty = spark.createDataFrame([([],)], "items ARRAY<STRING>")
    assert sk.to_csv_lines(empty).first().line == "[]"


def test_to_map_is_long(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2), (None, 9)], "k STRING, v INT")
    assert {r.k: r.v for r in sk.to_map(df, "k", "v").collect()} == {"a": 3, "b": 2}


def test_csv_lines_equal_python_str(spark):
    """Lists of ints, floats, strings with quotes and nulls, nested lists."""
    rng = random.Random(4)
    texts = ["x", "it's", 'say "hi"', "both ' and \"", "back\\slash", "tab\tnew\nline", "é 漢", "", "bell\x07", None]
    rows = []
    for _ in range(300):
        pick = lambda f: [f() if rng.random() > 0.15 else None for _ in range(rng.randrange(4))]
        rows.append((rng.randrange(-99, 99), pick(lambda: rng.randrange(10**12)), pick(lambda: rng.choice(texts)),
                     pick(lambda: float(f"{rng.uniform(-1, 1) * 10.0 ** rng.randrange(-20, 20):.14e}")), pick(lambda: rng.random() < 0.5),
                     [pick(lambda: rng.randrange(5))], rng.choice(texts), float(rng.randrange(100)) / 8))
    df = spark.createDataFrame(rows, "a LONG, i ARRAY<LONG>, t ARRAY<STRING>, d ARRAY<DOUBLE>, b ARRAY<BOOLEAN>, n ARRAY<ARRAY<LONG>>, s STRING, f DOUBLE")
    got = sorted(r.line for r in sk.to_csv_lines(df).collect())
    assert got == sorted(",".join(map(str, r)) for r in rows)


def test_scan_csv_leaves_the_session_alone(spark, tmp_dir):
    path = os.path.join(tmp_dir, "bad.csv")
    _write(path, "a,b\n1,2\n3\n4,5,6\n7,8\n9,x\n")
    key = "spark.sql.csv.parser.columnPruning.enabled"
    before = spark.conf.get(key)
    df = src.scan_csv(spark, path, "a INT, b INT")
    assert sorted(r.a for r in df.collect()) == [1, 7]
    assert df.count() == 3 and sorted(r.a for r in df.select("a").collect()) == [1, 7, 9]  # b isn't read
    assert spark.conf.get(key) == before


def test_file_row_index_follows_path_order(spark, tmp_dir):
    d = os.path.join(tmp_dir, "plants")
    os.makedirs(d)
    sizes = {"part-0.txt": 3, "part-1.txt": 400, "part-2.txt": 40}
    want, n = {}, 0
    for fname in sorted(sizes):
        lines = [f"{fname}-{i}" for i in range(sizes[fname])]
        _write(os.path.join(d, fname), "".join(x + "\n" for x in lines))
        for x in lines:
            want[x] = n
            n += 1
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        got = {r.value: r.id for r in src.file_row_index(src.scan_text(spark, d)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == want


def test_quoted_newline_counts_records_not_lines(spark, tmp_dir):
    p = os.path.join(tmp_dir, "ml.csv")
    _write(p, 'id,Nom_parc\n1,"LINE ONE\nLINE TWO"\n2,PARC\n')
    df = src.scan_csv(spark, p, "id INT, Nom_parc STRING", multiline=True)
    rows = sorted((r.id, r.Nom_parc) for r in df.collect())
    assert rows == [(1, "LINE ONE\nLINE TWO"), (2, "PARC")]


def test_empty_and_header_only_files(spark, tmp_dir):
    from quarry.operators import relational as rel

    empty = os.path.join(tmp_dir, "empty.csv")
    _write(empty, "")
    head = os.path.join(tmp_dir, "head.csv")
    _write(head, "id,Nom_parc\n")
    for p in (empty, head):
        df = src.scan_csv(spark, p, "id INT, Nom_parc STRING")
        assert rel.count_rows(df).first()["n_rows"] == 0
        assert rel.top_k_groups(df, "Nom_parc").count() == 0
    assert src.skip_header(src.scan_text(spark, head)).count() == 0


def test_dropmalformed_counts_only_surviving_records(spark, tmp_dir):
    from quarry.operators import relational as rel

    p = os.path.join(tmp_dir, "short_long.csv")
    _write(p, 'id,Nom_parc,n\n1,A,3\n2,B\n3,C,4,extra\n4,"D, E",5\n')
    df = src.scan_csv(spark, p, "id INT, Nom_parc STRING, n INT")
    assert rel.count_rows(df).first()["n_rows"] == 2
    assert df.count() == 2
    assert sorted(r.Nom_parc for r in df.select("Nom_parc").collect()) == ["A", "D, E"]


def test_to_csv_lines_doubles_like_python(spark):
    vals = [0.9860296172115116, 1e7, 12345678.5, 5e-4, 1e16, -2.5e-7]
    df = spark.createDataFrame([(f"r{i}", v) for i, v in enumerate(vals)], "k STRING, x DOUBLE")
    got = {r.line for r in sk.to_csv_lines(df).collect()}
    assert got == {f"r{i},{v}" for i, v in enumerate(vals)}


def _random_csv(rng, n, end="\n"):
    out = ["id,note,n"]
    for i in range(n):
        parts = [rng.choice(["x", 'q""q', "line" + end + "break", "c,c", "", "é漢", end, " ", '""'] + ["word"] * 6) for _ in range(rng.randrange(12))]
        note = '"' + "".join(parts) + '"' if rng.random() < 0.6 else rng.choice(["plain", "", 'in"side', 'two"q"uotes'])
        out.append(rng.choice([f"{i},{note},{i % 7}"] * 8 + [f'"{i}",{note},"{i % 7}"', f"{i},{note}", f"{i},{note},x,9", ""]))
    return end.join(out) + (end if rng.random() < 0.5 else "")


@pytest.mark.parametrize("size", [61, 401, 4096])
def test_multiline_csv_over_splits_equals_one_task(spark, tmp_dir, size):
    """Splits that end anywhere in a record give what one task reads, with several files and both line ends."""
    import random

    rng = random.Random(size)
    for k, end in enumerate(("\n", "\r\n", "\n")):
        _write(os.path.join(tmp_dir, f"f{k}.csv"), _random_csv(rng, 20 if size < 100 else 90, end))
    _write(os.path.join(tmp_dir, "empty.csv"), "")
    _write(os.path.join(tmp_dir, "head.csv"), "id,note,n\n")
    whole = (spark.read.schema("id INT, note STRING, n INT").option("header", True).option("multiLine", True).option("escape", '"')
             .option("mode", "DROPMALFORMED").option("columnPruning", False).option("nullValue", "").csv(tmp_dir))
    def plain(df):  # Spark's own reader turns the two-character line end inside quotes into one
        return sorted(str(r).replace("\\r\\n", "\\n") for r in df.collect())

    want = plain(whole)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]
    for n in names:
        spark.conf.set(n, str(size))
    try:
        got = src.scan_csv(spark, tmp_dir, "id INT, note STRING, n INT", multiline=True)
        assert plain(got) == want and len(want) > 30
        assert got.count() == len(want)
        assert spark.read.text(tmp_dir).rdd.getNumPartitions() >= (10 if size < 400 else 3)
    finally:
        for n, v in zip(names, old):
            spark.conf.set(n, v)


def test_multiline_csv_names_modes_and_open_quote(spark, tmp_dir):
    p = os.path.join(tmp_dir, "m.csv")
    _write(p, 'id,note\n1,"a\nb"\n2\n3,"never closed\n4,x\n')
    assert src.scan_csv(spark, p, None, multiline=True).columns == ["id", "note"]
    rows = src.scan_csv(spark, p, "id INT, note STRING", mode="PERMISSIVE", multiline=True).collect()
    assert (1, "a\nb") in [tuple(r) for r in rows] and (2, None) in [tuple(r) for r in rows]
    with pytest.raises(Exception, match="malformed CSV record"):
        src.scan_csv(spark, p, "id INT, note STRING", mode="FAILFAST", multiline=True).collect()


def test_line_as_function_of_the_open_quote():
    from quarry.sources.csv_records import inside_after

    cases = {'a,b': (0, 1), '"a': (1, 0), 'a"b': (0, 0), '"a"': (0, 0), '"a""': (1, 1), '"a"",': (1, 1), 'x,"y': (1, 0), 'y",z': (0, 0),
             'y","z': (0, 1), '"a",b"c,"d': (1, 0), '""': (0, 1), '': (0, 1), ',,"': (1, 0), '"x"y,"z': (1, 1), 'a,"b","c""': (1, 1)}
    for line, ends in cases.items():
        for before in (False, True):
            got = inside_after(line, before)
            # by hand: character by character
            state, at_start, i = before, not before, 0
            while i < len(line):
                c = line[i]
                if state:
                    if c == '"':
                        if line[i + 1: i + 2] == '"':
                            i += 1
                        else:
                            state, at_start = False, False
                elif c == '"' and at_start:
                    state = True
                else:
                    at_start = c == ","
                i += 1
            assert got == state, (line, before)


def test_record_too_long_is_null():
    from quarry.sources import csv_records as cr

    cut = cr._Cutter("f", 0, False)
    rows = cut.add(['1,"a', "x" * (cr.MAX_RECORD + 1), 'b",2', "3,c"]) + cut.rest()
    assert [(r[2], r[4]) for r in rows] == [(0, None), (0, "3,c")]
    cut = cr._Cutter("f", 9, True)
    assert [(r[2], r[4]) for r in cut.add(["x", "y"]) + cut.rest()] == [(2, "x\ny")]


def test_many_line_items_are_written_by_many_tasks(spark, tmp_dir, monkeypatch):
    import glob

    from quarry.plans import queries as q

    rows = [(i, i % 7, i % 50, "R", "O", float(i % 9)) for i in range(400)]
    items = spark.createDataFrame(rows, "l_orderkey LONG, l_linenumber INT, l_partkey LONG, l_returnflag STRING, l_linestatus STRING, l_quantity DOUBLE")
    items.repartition(4).write.parquet(f"{tmp_dir}/lineitem.parquet")
    paths = []
    monkeypatch.setattr(q, "fresh_path", lambda s, tag: paths.append(f"{tmp_dir}/out-{tag}") or paths[-1])
    monkeypatch.setattr(q, "ITEMS_A_FILE", 100, raising=False)
    got = sorted(tuple(r) for r in q.QUERIES["scan_csv_multiline"](spark, tmp_dir).collect())
    assert len(glob.glob(f"{paths[0]}/part-*")) > 1
    assert got == sorted((o, n, p, f'say "{f}",\n{s}, then\r\n{s}', x) for o, n, p, f, s, x in rows)
