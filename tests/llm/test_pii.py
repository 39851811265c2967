import hashlib
import re
from collections import Counter

from helpers import SF, awkward, documents, nothing
from hypothesis import given, settings
from hypothesis import strategies as st

from hourweave.llm.pii import KINDS, base_spans, bootstrap, find, op8_pii, personal_data


def luhn(digits):
    odd = [int(x) for x in digits[::-1]]
    return sum(odd[0::2] + [sum(divmod(2 * x, 10)) for x in odd[1::2]]) % 10 == 0


def plain(text):
    """The base patterns as they are written, by the regular expressions themselves."""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def joined(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


SAMPLES = ["a.b+c@mail.example.com", "@", "x@y", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1111 ",
           "+1 (017) 555-7713", "+49 30 1234567890123", " ", ".", "é", "\U0001f600", "0", "12345678901234", "-", "(", "\n", "٣"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(SAMPLES), max_size=9))
def test_base_spans_are_the_patterns(parts):
    assert base_spans("".join(parts)) == plain("".join(parts))


def test_query_base_columns_equal_the_patterns(spark):
    got = {r["doc_id"]: r for r in op8_pii(spark, SF).collect()}
    rows = documents()
    assert got.keys() == {i for i, _ in rows}
    for doc_id, text in rows:
        spans, r = plain(text or ""), got[doc_id]
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s[1] == i for s in spans) for i in range(4)]
        assert r["base_sha256"] == hashlib.sha256(joined(spans).encode()).hexdigest()
        assert set(joined(spans).split(",")) <= set(r["spans"].split(","))


def test_contexts_of_seeds_find_unseen_identifiers(spark):
    rows = [(i, f"Please call the office at +1 (20{i % 10}) 555-10{i:02d} today. It is fine. Noise {i} here.") for i in range(30)]
    rows += [(100 + i, f"Hello. Please call the office at 555-77{i:02d}-x9 today, thanks.") for i in range(5)]
    rows += [(200 + i, f"The code was 99887{i:02d} on paper.") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["base"], r["spans"]) for r in personal_data(docs).collect()}
    for i in range(5):
        text = dict(rows)[100 + i]
        (span,) = got[100 + i][1]
        assert not got[100 + i][0] and KINDS[span["kind"]] == "phone"
        assert text[span["start"]:span["end"]] == f"555-77{i:02d}-x9"
        assert not got[200 + i][1]
    assert all(len(got[i][1]) == len(got[i][0]) == 1 for i in range(30))
    taken, patterns = bootstrap(docs, find(docs))
    assert {r["kind"] for r in taken.collect()} == {"phone"} and patterns.filter("worth >= 0.5").count() >= 1


def test_common_contexts_say_nothing(spark):
    rows = [(i, f"meet at +1 (20{i % 10}) 555-10{i:02d} or") for i in range(5)] + [(50, "meet at 123456 or")]
    rows += [(60 + i, "we meet at noon or later, meet at home or not, meet at last or never") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert bootstrap(docs, find(docs))[0].count() == 0


def test_awkward_documents(spark):
    docs = awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = Counter((r["doc_id"], joined((s["start"], s["kind"], s["end"]) for s in r["base"])) for r in personal_data(docs).collect())
    assert got == Counter((i, joined(plain(t or ""))) for i, t in rows)
    assert personal_data(nothing(spark)).count() == 0


def test_identifiers_in_groups_are_found(spark):
    rows = [(i, f"Please call the office at +1 (20{i % 10}) 555-10{i:02d} today. It is fine. Chapter {i} here.") for i in range(30)]
    own = ["(030) 123 4567", "0301 234 567", "4111 1111 1111 1112", "DE89 3704 0044 0532 0130 01", "GB29 NWBK 6016 1331 9268 1",
           "AB 12 34 56 C", "0301 - 234 567", "x9-kfjd", "55512345 77712345"]
    rows += [(100 + i, f"Hello. Please call the office at {x} today, thanks. AB 12 is on 3 lines\n4 5") for i, x in enumerate(own)]
    got = {r["doc_id"]: r["spans"] for r in personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, x in enumerate(own):
        text = rows[30 + i][1]
        assert [text[s["start"]:s["end"]] for s in got[100 + i]] == [x]
    assert all(len(got[i]) == 1 for i in range(30))


def test_accepted_identifiers_induce_patterns(spark):
    rows = [(i, f"Please call the office at +1 (20{i % 10}) 555-10{i:02d} today. It is fine.") for i in range(60)]
    step = [f"555-77{i:02d}-x9" for i in range(5)]  # beside seeds' contexts, then in a context of their own, then another
    rows += [(100 + i, f"Please call the office at {x} today. My extension number: {x} forever.") for i, x in enumerate(step)]
    rows += [(200 + i, f"My extension number: 88-{i}-q forever. Badge shown was 88-{i}-q yesterday evening.") for i in range(2)]
    rows += [(300, "Badge shown was 99-7-z yesterday evening.")]
    rows += [(400 + i, f"Nothing but {i}{i} apples.") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["base"], r["spans"]) for r in personal_data(docs).collect()}
    text = dict(rows)
    found = {i: [text[i][s["start"]:s["end"]] for s in spans] for i, (_, spans) in got.items()}
    assert all(found[100 + i] == [x, x] for i, x in enumerate(step))
    assert all(found[200 + i] == [f"88-{i}-q"] * 2 for i in range(2))
    assert found[300] == ["99-7-z"]
    assert not any(found[400 + i] for i in range(5))
