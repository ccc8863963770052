import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeferry.functions import masking
from tests.conftest import plan_of

SAME = "="
EDGES = [
    # value, as a name, as a phone, as a short phone
    (None, SAME, SAME, SAME),
    ("", SAME, SAME, SAME),
    ("A", SAME, SAME, SAME),
    ("AB", "A*", SAME, SAME),
    ("ABC", "A*C", SAME, SAME),
    ("ABCD", "A*CD", "ABC****", "ABC*"),
    ("4444", "****", "*" * 16, "****"),
    ("abab", "a*a*", "a****a****", "a*a*"),
    ("12345", "1*345", "123****", SAME),
    ("13800008000", "1**00008000", "138****8000", SAME),
    ("12345674567", "1**45674567", "123********", SAME),
    ("Li Wei", "L* We*", "Li ****", SAME),
    ("Anna", "A**a", "Ann****", "Ann*"),
    ("王伟", "王*", SAME, SAME),
    ("王小明", "王*明", SAME, SAME),
    ("王王王", "***", SAME, SAME),
    ("欧阳小明", "欧**明", "欧阳小****", "欧阳小*"),
    ("欧阳欧阳", "欧**阳", "欧****欧****", "欧*欧*"),
    ("Customer#000000001", "C" + "*" * 18 + "1", "Cus****r#000000001", SAME),
    ("John Smithson", "J" + "*" * 13 + "n", "Joh****ithson", SAME),
    ("迪丽热巴迪力木拉提", SAME, "迪丽热****拉提", SAME),
    ("😀😀😀", "**😀", SAME, SAME),
    ("ééééé", "****é", "********é", SAME),
]


def one_by_one(spark, values, *masks):
    frame = spark.createDataFrame(list(enumerate(values)), "place int, value string")
    shown = frame.select("place", *[mask("value").alias(f"m{i}") for i, mask in enumerate(masks)])
    return [tuple(row)[1:] for row in sorted(shown.collect())]


def test_edge_values(spark):
    values = [edge[0] for edge in EDGES]
    masks = (masking.mask_name, masking.mask_phone, masking.mask_phone_short)
    wanted = [tuple(edge[0] if m == SAME else m for m in edge[1:]) for edge in EDGES]
    assert one_by_one(spark, values, *masks) == wanted


def test_hash(spark):
    got = one_by_one(spark, ["6222", "", None], masking.hash_token)
    digest = "3865e98e8d3fe3316c6b8cb24219bf0847bdd11b9f9b1940dda302111134c297"
    assert got == [(digest,), ("",), (None,)]


def test_salted_hash(spark):
    got = one_by_one(spark, ["6222", ""], lambda c: masking.hash_token(c, salt="pepper"))
    assert got == [(hashlib.sha256(b"pepper6222").hexdigest(),), ("",)]


def test_strict_names_keep_their_length(spark):
    names = ["A", "AB", "ABC", "迪丽热巴迪力木拉提", "x" * 40, "", None]
    got = one_by_one(spark, names, masking.mask_name_strict)
    assert got == [
        ("*",), ("A*",), ("A*C",), ("迪" + "*" * 7 + "提",), ("x" + "*" * 38 + "x",), ("",), (None,),
    ]


def test_numbers_become_text(spark):
    frame = spark.range(13800008000, 13800008001).select(masking.mask_phone("id").alias("phone"))
    assert frame.first()[0] == "138****8000"
    assert frame.schema["phone"].dataType.simpleString() == "string"


def _name_in_python(name):
    size = len(name.encode())
    if size <= 9:
        piece, stars = name[1:2], "*"
    elif size <= 12:
        piece, stars = name[1:3], "**"
    elif size <= 24:
        piece, stars = name[1:-1], "*" * len(name)
    else:
        return name
    return name.replace(piece, stars) if piece else name


def _phone_in_python(phone):
    return phone.replace(phone[3:7], "****") if len(phone) >= 4 else phone


text = st.text(st.characters(exclude_categories=("Cs",), exclude_characters="\0"), max_size=30)
repetitive = st.text("ab1王é", max_size=12)


@settings(max_examples=8, deadline=None)
@given(values=st.lists(st.one_of(text, repetitive), min_size=1, max_size=200))
def test_against_python(spark, values):
    got = one_by_one(spark, values, masking.mask_name, masking.mask_phone)
    assert got == [(_name_in_python(value), _phone_in_python(value)) for value in values]


@pytest.mark.parametrize(
    "mask",
    [
        masking.mask_name,
        masking.mask_phone,
        masking.mask_phone_short,
        masking.hash_token,
        masking.mask_name_strict,
    ],
)
def test_masks_stay_in_codegen(spark, mask):
    plan = plan_of(spark.range(9).select(mask(F.col("id")).alias("masked")))
    assert "Python" not in plan
    assert "* Project" in plan
