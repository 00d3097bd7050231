"""Identifiers in groups of digits, in a context learnt from others."""

from hard_rows import prose

from tidemark.llm import pii


def luhn(body: int) -> str:
    return next(f"{body}{d}" for d in range(10) if pii.luhn(f"{body}{d}"))


def spaced(card: str) -> str:
    return " ".join(card[i:i + 4] for i in range(0, 16, 4))


def test_runs_of_digit_groups_are_one_place():
    for text, places in (("at 212 555 0100 and", ["212 555 0100"]), ("x (017) 555-7713, then", ["(017) 555-7713"]),
                         ("no 4539 1488 0343 6461.", ["4539 1488 0343 6461"]), ("pin 123 is", ["123"]),
                         ("a1 22 3b 44", ["a1", "22", "3b", "44"]), ("8 9, 10  11", ["8 9", "10", "11"]),
                         ("tel 212.555.0100 x", ["212.555.0100"]), ("mail a@b 1", ["a@b", "1"])):
        assert [v for _, _, _, v, _ in pii.slots(text, pii.base_spans(text))] == places


def test_long_runs_take_linear_time():
    for text in ("1 " * 200_000, "1" * 200_000 + "x", "1-" * 100_000 + "x", "(1) " * 100_000, "@" * 200_000):
        assert len(pii.slots(text, [])) >= 1


def test_contexts_find_spaced_phones_and_cards(spark):
    made = [(i, f"{prose(i, 9)} my card number: {spaced(luhn(453914880343600 + 7 * i))} and {prose(i, 5)}") for i in range(30)]
    made += [(50 + i, f"{prose(i, 9)} please call me: +1 (212) 555-{1000 + i} and {prose(i, 5)}") for i in range(30)]
    unseen = {100: "4539 1488 0343 6461", 101: "212 555 0100", 102: "(017) 555-7713", 103: "12345"}
    made += [(i, f"{prose(3, 4)} {'card number:' if i == 100 else 'call me:'} {v} and {prose(3, 9)}") for i, v in unseen.items()]
    out = {r["row"]["doc_id"]: r["spans"] for r in pii.personal_data(spark.createDataFrame(made, "doc_id long, text string")).collect()}
    texts = dict(made)
    found = {i: [(pii.KINDS[s["kind"]], texts[i][s["start"]:s["end"]]) for s in out[i]] for i in unseen}
    assert found == {i: [("context_card" if i == 100 else "context_phone", v)] for i, v in unseen.items()}
    assert all(len(out[i]) == 1 for i in range(30))
