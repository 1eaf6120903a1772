"""Readers, parsers and scalar helpers."""

from pyspark.sql import functions as F

from weirflow.functions import scalars as fn
from weirflow.sources import readers, schemas


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_line_numbers_over_many_splits(spark, tmp_path):
    (tmp_path / "a.txt").write_text("".join(f"title {i}\n" for i in range(1, 2001)))
    (tmp_path / "b.txt").write_text("".join(f"other {i}\n" for i in range(1, 301)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        numbered = readers.numbered_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(numbered) == 2300
    assert len({(r.file, r.split_at) for r in numbered}) > 20
    assert all(r.value.split()[1] == str(r.line_no) for r in numbered)


def test_titles(spark, tmp_path, rows):
    (tmp_path / "titles").write_text("a\nb\nc\nd\n")
    titles = readers.titles(readers.numbered_lines(spark, str(tmp_path / "titles")))
    assert rows(titles) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]


def test_glob_over_folders(spark, tmp_path):
    for name in ("x1", "x2"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part-0").write_text(f"{name}\n")
    assert readers.text_lines(spark, f"{tmp_path}/x*/*").count() == 2
    assert readers.text_lines(spark, str(tmp_path), recursive=True).count() == 2


def test_stored_tag_use(spark):
    row = readers.parse_tag_uses(lines(spark, "(ann42,happybirthday 1555969426304 0 0 0 0 False True low)", "junk")).collect()
    assert [tuple(r) for r in row] == [("ann42", "happybirthday", 1555969426304, 0, 0, 0, 0, False, True, "low")]


STORED_USER = (
    "(BobExample,50495 49713 282 1445416821000.0 15299 None False False 434339 False False True False False "
    "None None None none)"
)


def test_stored_user(spark):
    user = readers.parse_users(lines(spark, STORED_USER)).collect()[0]
    assert user.screen_name == "BobExample"
    assert (user.followers_count, user.created_ms, user.statuses_count) == (50495, 1445416821000, 434339)
    assert (user.following, user.profile_use_background_image, user.translator_type) == (False, True, "none")
    assert len(user) == len(schemas.USER_FIELDS) + 1


def test_stored_relation(spark, rows):
    assert rows(readers.parse_relations(lines(spark, "(carol7,DAVE)"))) == [("carol7", "DAVE")]


def test_wire_formats(spark, rows):
    assert rows(readers.wire_relations(lines(spark, "u,f1:u,f2:", "", ":"))) == [("u", "f1"), ("u", "f2")]
    use = readers.wire_tag_uses(lines(spark, "u,news,1555969426304,1,2,3,4,False,True,low,", "")).collect()
    assert [tuple(r) for r in use] == [("u", "news", 1555969426304, 1, 2, 3, 4, False, True, "low")]
    user = readers.wire_users(lines(spark, STORED_USER[1:-1].replace(" ", ",") + ":")).collect()
    assert [(r.screen_name, r.created_ms) for r in user] == [("BobExample", 1445416821000)]


def test_bad_json_lines_are_kept_apart(spark, rows):
    good, bad = readers.permissive_json(lines(spark, '{"a": 1}', "{oops", '{"a": "x"}', "null"), "a int")
    assert rows(good) == [(1,)]
    assert bad.count() == 3


def test_libsvm(spark, tmp_path):
    (tmp_path / "data.txt").write_text("1.0 1:0.5 3:2\n0.0 2:1\n")
    frame = readers.libsvm(spark, str(tmp_path / "data.txt"), 3)
    assert sorted(r.label for r in frame.collect()) == [0.0, 1.0]


def test_topic_payload(spark, rows):
    message = spark.createDataFrame([("users/ann/office/d7", "21.5/40")], "topic string, payload string")
    assert rows(readers.decode_topic_payload(message)) == [("ann", "d7", "office", 21.5, 40.0)]


def test_synthetic_sources_repeat(spark, rows):
    assert rows(readers.random_integers(spark, 50, 3)) == rows(readers.random_integers(spark, 50, 3))
    chosen = readers.random_choices(spark, 50, 3, ["x", "y"])
    assert {r.sentence for r in chosen.collect()} == {"x", "y"}
    assert readers.cyclic_batches(spark, [("a",), ("b",)], "word string", 3).count() == 6


def test_scalars(spark):
    row = (
        spark.range(1)
        .select(
            fn.api_date_ms(F.lit("Wed Oct 21 08:40:21 +0000 2015")).alias("date"),
            fn.whole(F.lit("1445416821000.0")).alias("whole"),
            fn.lenient_bool(F.lit("None")).alias("none"),
            fn.lenient_bool(F.lit("True")).alias("true"),
            fn.from_hex(F.lit("0xdeadbeef")).alias("hex"),
            fn.to_hex(F.lit(0xDEADBEEF)).alias("digits"),
            fn.drop_last(F.lit("name u"), 2).alias("name"),
            fn.ring_slot(F.lit(4), 5).alias("slot"),
            fn.days_before(F.lit(86_400_000 * 5), 3).alias("days"),
        )
        .first()
    )
    assert tuple(row) == (
        1445416821000, 1445416821000, False, True, 0xDEADBEEF, "deadbeef", "name", 0, 172_800_000
    )


def test_whole_numbers_keep_their_digits(spark):
    from weirflow.functions.scalars import whole

    texts = ["9007199254740993", "1445416821000.0", "-7.9", "None", "", None, "1e3", " 12 ", "99999999999999999999", "x1"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.n for r in frame.orderBy("i").select(whole("t").alias("n")).collect()]
    assert got == [9007199254740993, 1445416821000, -7, None, None, None, 1000, 12, None, None]
