"""Readers on real text files, and the text forms of results written and read back."""

import pytest
from pyspark.sql import Observation

import sluice
from sluice import sinks
from sluice.sources import text


@pytest.fixture
def lines(spark, tmp_path):
    def write(content, name="in.txt"):
        path = tmp_path / name
        path.write_bytes(content.encode())
        return text.read_lines(spark, str(path))

    return write


def test_read_lines(lines, result):
    assert result(lines("a\nb\r\nc")) == [("a",), ("b",), ("c",)]


def test_pages(lines, result):
    rejects = Observation("pages")
    found = text.parse_pages(lines("1\tT\td\tx\ty z\n1\tT\td\tx\nplain\n"), rejects)
    assert result(found) == [("1", "T", "d", "x\ty z")]
    assert rejects.get["rejected"] == 2


def test_arcs(lines, result):
    assert result(text.parse_arcs(lines("a\tb\na\tb\tmore\nb\na\t\n"))) == [("a", "b")]


def test_nodes(lines, result):
    assert result(text.parse_nodes(lines("1\tOne\n2\tTwo\tx\n3\n"))) == [("1", "One"), ("2", "Two")]


def test_counts(lines, result):
    content = "the\t3000000000\na\t10\na e\tx\nb\t1\t2\nc\t99999999999999999999\nd\t+4\n"
    assert result(text.parse_counts(lines(content))) == [("a", 10), ("d", 4), ("the", 3000000000)]


def test_model_from_a_count_file(lines, result):
    counts = text.parse_counts(lines("a\t10\na b\t4\na c\t4\na d\t2\na e\tx\nz y\t5\n"))
    assert result(sluice.language_model(counts), "prefix", "rank", "word", "prob") == [
        ("a", 1, "b", 0.4), ("a", 2, "c", 0.4), ("z", 1, "y", None),
    ]


def test_photo_rows(lines, result):
    found = text.parse_photo_rows(lines("5,t,u\na,b,\na,b,c,,\na,b,c,d\n,,\n"))
    assert result(found) == [("5", "t", "u"), ("a", "b", "c")]


def test_edge_list_and_seeds(lines, result):
    arcs = text.parse_edge_list(lines("# from to\n1 2\n1\t2\n 3  4 \nx 5\n\n", "edges.txt"))
    assert result(arcs) == [(1, 2), (3, 4)]
    assert result(text.parse_seeds(lines("9 8\n 9\n", "seeds.txt"))) == [(8,), (9,)]


def test_ranks_from_text_files(lines, result):
    arcs = text.parse_arcs(lines("a\tb\na\tb\na\tc\nb\tc\n", "arcs.txt"))
    nodes = text.parse_nodes(lines("a\tA\nb\tB\nc\tC\nd\tD\n", "nodes.txt"))
    top = sluice.pagerank_top(sluice.pagerank(arcs, nodes, iterations=1), nodes, 1)
    assert [(t, round(r, 6)) for t, r in result(top)] == [("C", 1.85)]


def test_user_tables(spark, table, tmp_path, result):
    path = str(tmp_path / "users")
    table("userid bigint, password string, name string, more int", (1, "p", "Ann", 3)).write.parquet(path)
    assert result(text.read_users(spark, path)) == [(1, "p", "Ann")]
    with pytest.raises(ValueError, match="either"):
        text.read_users(spark)
    photos = str(tmp_path / "photos")
    table("userid bigint, time string, url string", (1, "t", "u")).write.parquet(photos)
    assert result(text.read_photos(spark, photos)) == [(1, "t", "u")]


def written(spark, path):
    return sorted(row.value for row in spark.read.text(path).collect())


def test_counts_round_trip(spark, table, tmp_path, result):
    counts = table("phrase string, cnt bigint", ("the", 3_000_000_000), ("a b", 1))
    path = str(tmp_path / "counts")
    sinks.write_counts(counts, path)
    assert result(text.parse_counts(text.read_lines(spark, path))) == result(counts)


def test_model_lines_keep_words_without_probability(spark, table, tmp_path):
    model = table(
        "prefix string, rank int, word string, cnt bigint, prob double",
        ("a", 2, "c", 4, 0.25), ("a", 1, "b", 8, 0.5), ("z", 1, "y", 5, None),
    )
    path = str(tmp_path / "model")
    sinks.write_model(model, path)
    assert written(spark, path) == ["a\tb,0.5\tc,0.25", "z\ty,"]


def test_ranked_lines(spark, table, tmp_path):
    path = str(tmp_path / "ranked")
    sinks.write_ranked(table("title string, score double", ("T", 1.5)), "score", path)
    assert written(spark, path) == ["T\t1.5"]


def test_path_lines(spark, table, tmp_path):
    arcs = table("src bigint, dst bigint", (3, 9), (7, 3))
    path = str(tmp_path / "paths")
    sinks.write_paths(sluice.shortest_paths_to(arcs, table("seed bigint", (9,))), path)
    assert written(spark, f"{path}/seed=9") == ["3\t9\t3 9", "7\t9\t7 3 9", "9\t9\t9 9"]


def test_export_lines(spark, table, tmp_path):
    path = str(tmp_path / "items")
    sinks.write_items(sluice.photo_export(table("userid string, time string, url string", ("5", "t", "u"))), path)
    assert written(spark, path) == ['url\x03{"s":"u"}\x02userid\x03{"n":"5"}\x02time\x03{"s":"t"}']


@pytest.mark.parametrize(
    ("format", "lines", "arcs", "rejected"),
    [
        ("snap", ["# from to", "1\t2", " 3   4 ", "5", "a b", "", "1 2"], [(1, 2), (3, 4)], 2),
        ("tsv", ["1\t2", "-3\t4", "1 2", "1\t2\t3", "a\t1", "", "1\t2"], [(-3, 4), (1, 2)], 3),
        (
            "adj",
            ["1 2 3 4", "2\t1  5", "3 0", "4 1", "5 1 2 3", "6 1 x", "x 1 2", "7", "", "1 1 3", " 8 -1", "9 1 1 "],
            [(1, 3), (1, 4), (2, 5), (9, 1)],
            6,
        ),
    ],
)
def test_graph_formats(spark, tmp_path, result, format, lines, arcs, rejected):
    path = tmp_path / "graph.txt"
    path.write_text("\n".join(lines) + "\n")
    seen = Observation()
    assert result(sluice.read_graph(spark, str(path), format, seen)) == sorted(arcs, key=repr)
    assert seen.get["rejected"] == rejected


def test_unknown_graph_format(table):
    with pytest.raises(ValueError, match="snap, tsv, adj"):
        sluice.parse_graph(table("value string"), "graphml")


def test_a_long_adjacency_line(table):
    line = f"7 200000 {' '.join(map(str, range(200_000)))}"
    assert sluice.parse_graph(table("value string", (line,)), "adj").count() == 200_000
