"""Reading and writing CSV extracts."""

import bz2
import gzip
import random

import pytest

from starmart.sources import RAW_SOURCES, read_all_raw, read_raw, source_path, write_raw
from starmart.sources.raw_csv import read_stitched
from tests.conftest import failing
from tests.fixtures import CSV, write_sources


def test_all_nine_sources_are_registered():
    assert len(RAW_SOURCES) == 9


def test_paths_follow_the_pattern_unless_named():
    assert source_path("raw/", "orders") == "raw/orders.csv"
    assert source_path("raw", "orders", "shop_{name}_v1.csv") == "raw/shop_orders_v1.csv"
    assert source_path("raw", "orders", file_names={"orders": "o.csv"}) == "raw/o.csv"
    with pytest.raises(KeyError):
        source_path("raw", "refunds")


def test_columns_are_text_and_empty_fields_null(spark, tmp_path):
    base = write_sources(tmp_path)
    orders = read_raw(spark, base, "orders")
    assert {kind for _, kind in orders.dtypes} == {"string"}
    assert orders.columns == list(RAW_SOURCES["orders"].columns)
    row = orders.filter("order_id = 'o3'").first()
    assert row.order_approved_at is None
    assert row.order_delivered_carrier_date is None
    assert read_raw(spark, base, "customers").first().customer_zip_code_prefix == "01037"


def test_columns_are_found_by_name(spark, tmp_path):
    text = "extra,seller_state,seller_city,seller_id,seller_zip_code_prefix\nx,sp,a,s1,9\n"
    base = write_sources(tmp_path, sellers=text)
    row = read_raw(spark, base, "sellers").first()
    assert row.asDict() == {
        "seller_id": "s1",
        "seller_zip_code_prefix": "9",
        "seller_city": "a",
        "seller_state": "sp",
    }


def test_missing_column_is_refused(spark, tmp_path):
    base = write_sources(tmp_path, sellers="seller_id,seller_city\ns1,a\n")
    with failing("seller_zip_code_prefix"):
        read_raw(spark, base, "sellers")


@pytest.mark.parametrize("row", ["s1,1,a", "s1,1,a,sp,more"])
def test_ragged_row_is_refused_whatever_is_selected(spark, tmp_path, row):
    header = CSV["sellers"].splitlines()[0]
    base = write_sources(tmp_path, sellers=f"{header}\n{row}\n")
    with failing("FAILED_READ_FILE"):
        read_raw(spark, base, "sellers").select("seller_id").collect()


def test_other_separator(spark, tmp_path):
    base = write_sources(tmp_path, sellers=CSV["sellers"].replace(",", ";"))
    assert read_raw(spark, base, "sellers", sep=";").count() == 2


def test_quoted_line_breaks_and_doubled_quotes(spark, tmp_path):
    reviews = read_raw(spark, write_sources(tmp_path), "order_reviews")
    row = reviews.filter("review_id = 'r1'").first()
    assert row.review_comment_title == "great, really"
    assert row.review_comment_message == 'line one\nline "two"\n\nline four'
    assert reviews.count() == 4


def test_only_named_sources_are_needed(spark, tmp_path):
    base = write_sources(tmp_path)
    assert list(read_all_raw(spark, base, names=["orders", "sellers"])) == ["orders", "sellers"]


def test_write_then_read_gives_the_same_rows(spark, tmp_path):
    base = write_sources(tmp_path)
    reviews = read_raw(spark, base, "order_reviews")
    write_raw(reviews, f"{tmp_path}/again/order_reviews.csv")
    again = read_raw(spark, f"{tmp_path}/again", "order_reviews")
    assert sorted(map(str, again.collect())) == sorted(map(str, reviews.collect()))


HEADER = ",".join(RAW_SOURCES["order_reviews"].columns)


def _random_reviews(seed: int, rows: int, line_end: str = "\n"):
    """Records whose comments mix line breaks, quotes, commas and long stretches."""
    draw = random.Random(seed)
    pieces = ["word", "\n", '"', '""', ",", "\n\n", "ção", " ", "x" * 300, '\n"', '"\n', "\r\n"]
    expected, lines = [], [HEADER]
    for number in range(rows):
        message = "m" + "".join(draw.choice(pieces) for _ in range(draw.randint(0, 12))) + "m"
        expected.append((f"r{number}", message))
        quoted = message.replace('"', '""')
        lines.append(f'r{number},o{number},5,,"{quoted}",,')
    return expected, line_end.join(lines) + line_end


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
@pytest.mark.parametrize("split", ["200b", "1000b", "40000b"])
def test_stitched_records_match_whatever_the_splits(spark, settings, tmp_path, split, line_end):
    folder = tmp_path / "order_reviews.csv"
    folder.mkdir()
    expected = []
    for part in range(2):
        rows, text = _random_reviews(part, 80, line_end)
        expected += rows
        (folder / f"part{part}.csv").write_text(text, newline="")
    settings(
        spark__sql__files__maxPartitionBytes=split, spark__sql__files__openCostInBytes="1"
    )
    got = read_stitched(spark, str(folder)).select("review_id", "review_comment_message")
    assert sorted(map(tuple, got.collect())) == sorted(expected)


# Stray quotes in unquoted and behind quoted fields, bare carriage returns, mixed line ends,
# quotes right before and after line breaks, empty quoted fields.
ODD = (
    'a,b,c\n1,5" tall,x\r2,"q ""\r\n"" r",y\r\n3,"",z"z"\n4,"""\n""",\r5,p"q,"r\ns"\n\n\r\r\n'
    '6,"end",""\r\n7,"\r",8" and 9"\n8,"a""b\n,\n""","\n"\r9,x,y'
)
ODD_ROWS = [
    ("1", '5" tall', "x"), ("2", 'q "\r\n" r', "y"), ("3", None, 'z"z"'), ("4", '"\n"', None),
    ("5", 'p"q', "r\ns"), ("6", "end", None), ("7", "\r", '8" and 9"'), ("8", 'a"b\n,\n"', "\n"),
    ("9", "x", "y"),
]


@pytest.mark.parametrize("split", [1, 2, 3, 5, 7, 11, 13, 40, 1000])
def test_odd_text_is_read_alike_at_any_split(spark, settings, tmp_path, split):
    path = tmp_path / "odd.csv"
    path.write_text(ODD, newline="")
    settings(
        spark__sql__files__maxPartitionBytes=f"{split}b", spark__sql__files__openCostInBytes="1"
    )
    assert sorted(map(tuple, read_stitched(spark, str(path)).collect())) == ODD_ROWS


@pytest.mark.parametrize("split", ["700b", "134217728b"])
@pytest.mark.parametrize("end", ["csv", "csv.gz", "csv.bz2"])
def test_sources_are_read_alike_at_any_size_and_compression(spark, settings, tmp_path, split, end):
    rows, text = _random_reviews(3, 300)
    folder = tmp_path / "order_reviews.csv"
    folder.mkdir()
    pack = {"csv": bytes, "csv.gz": gzip.compress, "csv.bz2": bz2.compress}[end]
    (folder / f"part.{end}").write_bytes(pack(text.encode()))
    settings(
        spark__sql__files__maxPartitionBytes=split, spark__sql__files__openCostInBytes="1"
    )
    got = read_raw(spark, str(tmp_path), "order_reviews")
    got = got.select("review_id", "review_comment_message")
    assert sorted(map(tuple, got.collect())) == sorted(rows)


@pytest.mark.parametrize("split", ["1000000b", "2800000b", "134217728b"])
def test_large_records_load_or_fail_alike_at_any_split(spark, settings, tmp_path, split):
    path = tmp_path / "large.csv"
    path.write_text('a,b\n1,"' + "filler\n" * 1_700_000 + '"\n2,x\n')
    settings(spark__sql__files__maxPartitionBytes=split)
    got = read_stitched(spark, str(path)).selectExpr("a", "length(b) AS size").collect()
    assert sorted(map(tuple, got)) == [("1", 11_900_000), ("2", 1)]
    with failing("oversized record"):
        read_stitched(spark, str(path), max_record_bytes=5_000_000).collect()


def test_byte_order_mark_and_blank_lines(spark, tmp_path):
    path = tmp_path / "marked.csv"
    path.write_text('\ufeffa,b\r\n1,"x\r\ny"\r\n\r\n2,z\r\n', newline="", encoding="utf-8")
    got = read_stitched(spark, str(path))
    assert got.columns == ["a", "b"]
    assert sorted(map(tuple, got.collect())) == [("1", "x\r\ny"), ("2", "z")]


def test_stitched_files_must_share_a_header(spark, tmp_path):
    folder = tmp_path / "order_reviews.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("x,y\n1,2\n")
    (folder / "b.csv").write_text("y,x\n3,4\n")
    with failing("different headers"):
        read_stitched(spark, str(folder)).collect()


@pytest.mark.parametrize("split", ["4000000b", "134217728b"])
def test_unbalanced_quote_stops_before_a_file_becomes_one_record(spark, settings, tmp_path, split):
    path = tmp_path / "open.csv"
    path.write_text('a,b\n1,"never closed\n' + "filler\n" * 2_000_000)
    settings(spark__sql__files__maxPartitionBytes=split)
    with failing("unbalanced quote"):
        read_stitched(spark, str(path), max_record_bytes=2_000_000).collect()
