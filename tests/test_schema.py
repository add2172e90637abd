import pytest

from driftline.schema import Column, Extras, ForeignKey, Table, Type, classify, ddl, id_override, quoted, rekey

A, B = ForeignKey(("a",), "x"), ForeignKey(("b",), "y")
COL = lambda n, t="int64", nullable=False: Column(n, Type.of(t), nullable)


@pytest.mark.parametrize(
    "table, forced, relation",
    [
        (Table("t", COL("id")), (), False),
        (Table("t", COL("a"), (COL("b"),), (A,), ("a", "b")), (), False),
        (Table("t", COL("a"), (COL("b"),), (A, B), ("a", "b")), (), True),
        (Table("t", COL("id"), (COL("a"), COL("b")), (A, B)), (), False),
        (Table("t", COL("a"), (COL("b"), COL("c")), (A, B), ("a", "b", "c")), (), False),
        (Table("t", COL("id"), (COL("a"), COL("b")), (A, B)), ("t",), True),
        (Table("t", COL("id"), (COL("a"), COL("b")), (A, ForeignKey(("b",), "x"))), ("t",), True),
        (Table("t", COL("a"), (COL("b"),), (A, ForeignKey(("b",), "x")), ("a", "b")), (), False),
        (Table("t", COL("id"), (COL("a"),), (A,)), ("t",), False),
    ],
)
def test_classify(table, forced, relation):
    assert bool(classify(table, forced)) == relation


def test_types():
    assert Type.of("decimal(10,2)").spark().simpleString() == "decimal(10,2)"
    assert Type.of("array<int>").sink() == "array<int>" and Type.of("array<int>").spark().simpleString() == "array<int>"
    assert Type.of("timestamptz").sink() == "datetime" and Type.of("decimal(60,50)").spark().simpleString() == "string"
    with pytest.raises(ValueError):
        Type.of("sql_variant")


def test_ids():
    assert id_override("ledger=a, b") == ("ledger", ("a", "b"))
    with pytest.raises(ValueError):
        id_override("ledger")
    t = Table("ledger", COL("id"), (COL("a"), COL("amount")))
    assert rekey([t], {"ledger": ("a", "z")})[0].key_columns == ["a", "z"]
    assert rekey([t], {"ledger": ("z",)})[0].key.type.name == "text"
    with pytest.raises(ValueError):
        rekey([t], {"nothing": ("a",)})


def test_ddl():
    books = Table("books", COL("id"), (COL("author id", "int64", True), COL("till", "date")), (ForeignKey(("author id",), "authors"),))
    tags = Table("book_tags", COL("a"), (COL("b"), COL("n", "text", True)), (A, B), ("a", "b"))
    got = ddl([books, tags], Extras(indexes=(("i", "books", ("till",), True), ("j", "books", ("id",), False)), periods=(("books", "id", "till"),), fields=(("books", "extra", "int", True), ("books", "id", "int", True))))
    assert got == [
        "DEFINE TABLE books SCHEMAFULL;",
        "DEFINE FIELD id ON books TYPE int;",
        "DEFINE FIELD `author id` ON books TYPE option<record<authors>>;",
        "DEFINE FIELD till ON books TYPE datetime ASSERT $parent.id <= $value;",
        "DEFINE FIELD extra ON books TYPE option<int>;",
        "DEFINE TABLE book_tags TYPE RELATION IN x OUT y SCHEMAFULL;",
        "DEFINE FIELD n ON book_tags TYPE option<string>;",
        "DEFINE INDEX i ON books FIELDS till UNIQUE;",
    ]
    assert quoted("a`b") == "`a``b`"
