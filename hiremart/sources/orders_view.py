"""Postings view over the driver's ``orders`` table (FIXTURES.md §1).

The check tables hold no job postings, so the driver queries read a view
built from ``orders``: every order becomes one posting whose raw texts are
taken from short hand-made value lists by simple key arithmetic.  The work
therefore grows with ``orders`` while the texts cover the edge cases.

The same lists feed the DuckDB oracle (``__spark_entry__.oracle_sql``), and
the tests assert the expected values of FIXTURES.md §3 literally, so an
error in a shared list is caught.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Test inputs of FIXTURES.md §3, index order.
LOCATIONS = [
    None, "", "Không hiển thị", "Negotiable", "Tokyo, Japan", "Hà Nội", "TP. Hồ Chí Minh",
    "Quận 7", "Đà Nẵng", "Hải Phòng", "Vĩnh Phúc", "Thủ Đức", "Vĩnh Long", "Trà Vinh",
    "Long Hồ", "Tân Uyên, Bình Dương", "Bình Dương", "Hà Nội | Đà Nẵng", "Đồng Văn, Hà Giang",
    "Cần Thơ", "Huế", "Johnson Plaza", "Tây Ninh", "Somewhere else",
]
INDUSTRIES = [
    None, "   ", "Không hiển thị", "Kinh doanh", "Kế toán / Kiểm toán",
    "Công nghệ thông tin, Viễn thông", "Marketing > Digital", "  Xây   dựng ", "/Logistics",
    "Logistics", "Ố", "Y tế, Dược / Hóa",
]
EXPERIENCES = [
    None, "Không hiển thị", "Dưới 1 năm", "1 năm", "3", "5 - 10 năm", "7 năm", "10 năm", "0",
    "Trên 5 năm", "Thỏa thuận", "15 - 100",
]
EDUCATIONS = [
    None, "Khác", "Không giới hạn", "Trung học cơ sở (Cấp 2) trở lên", "Trung học", "Cử nhân",
    "Đại học trở lên", "Thạc sĩ", "Trung cấp trở lên", "Cao đẳng", "Cao đẳng trở lên",
]
EMPLOYMENT_TYPES = [
    None, "Khác", "Toàn thời gian cố định", "Toàn thời gian", "Toàn thời gian tạm thời",
    "Bán thời gian", "Hợp đồng thời vụ", "Thực tập", "Làm tại nhà",
]
SKILLS = [None, "", "SQL, Python", "C++; Java", "/", "Excel|Word[Office]", " , ", "a,  ,b", "UNKNOWN"]
TITLES = ["Kế toán trưởng", "  Sales  ", "", "   ", None]

# (column, value list, (a, b)): the list index is (a * o_orderkey + b * o_custkey) mod len.
VIEW_COLUMNS = [
    ("raw_title", TITLES, (1, 0)),
    ("raw_ind", INDUSTRIES, (0, 1)),
    ("raw_loc", LOCATIONS, (1, 0)),
    ("raw_exp", EXPERIENCES, (1, 1)),
    ("raw_req", SKILLS, (1, 0)),
    ("raw_skill", SKILLS, (1, 5)),
    ("raw_edu", EDUCATIONS, (1, 3)),
    ("raw_type", EMPLOYMENT_TYPES, (2, 1)),
]
SECTOR_BY_STATUS = [("P", "Không hiển thị"), ("F", None)]
SECTOR_OTHER = "Sector O"


def _pick(values: list, coef: tuple[int, int]) -> Column:
    a, b = coef
    idx = F.col("o_orderkey") * a + F.col("o_custkey") * b
    arr = F.array(*[F.lit(v).cast("string") for v in values])
    return F.element_at(arr, (F.pmod(idx, F.lit(len(values))) + 1).cast("int"))


def postings_view(orders: DataFrame) -> DataFrame:
    """job_base_clean-shaped postings, one per order (columns of §1.3)."""
    cols = {name: _pick(values, coef).alias(name) for name, values, coef in VIEW_COLUMNS}
    sec = F.when(F.col("o_orderstatus") == "P", F.lit(SECTOR_BY_STATUS[0][1])).when(
        F.col("o_orderstatus") == "F", F.lit(None).cast("string")
    ).otherwise(F.lit(SECTOR_OTHER))
    return orders.select(
        (F.col("o_orderkey") + 1).cast("long").alias("job_id"),
        cols["raw_title"], cols["raw_ind"], sec.alias("raw_sec"), cols["raw_loc"], cols["raw_exp"],
        cols["raw_req"], cols["raw_skill"], cols["raw_edu"], cols["raw_type"],
    )


def _sql_literal(v) -> str:
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'"


def postings_view_sql(orders_table: str = "orders") -> str:
    """The same view in ANSI SQL (DuckDB lists are 1-based)."""
    sel = ["CAST(o_orderkey + 1 AS BIGINT) AS job_id"]
    for name, values, (a, b) in VIEW_COLUMNS:
        idx = f"{a} * o_orderkey + {b} * o_custkey"
        lst = "[" + ", ".join(_sql_literal(v) for v in values) + "]::VARCHAR[]"
        sel.append(f"({lst})[CAST((({idx}) % {len(values)}) + 1 AS INTEGER)] AS {name}")
        if name == "raw_ind":
            sel.append(
                "CASE o_orderstatus WHEN 'P' THEN 'Không hiển thị' WHEN 'F' THEN NULL ELSE 'Sector O' END AS raw_sec"
            )
    return f"SELECT {', '.join(sel)} FROM {orders_table}"
