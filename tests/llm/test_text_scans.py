"""Scans without a shuffle: contamination, tokens, secrets, personal data."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from marlstone.llm import pii
from marlstone.llm.decontaminate import decontaminate, find_contamination
from marlstone.llm.queries import op4_trigram_secrets, op7_decontaminate, vocabulary
from marlstone.llm.secret_scan import RULES, scan_secrets, trigram_query, trigrams_of
from marlstone.llm.token_count import Counter, count_tokens, load_vocabulary, merge_counts

from .conftest import passage

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def words(t):
    return WORD.findall((t or "").translate(ASCII_LOWER))


def brute(docs, items):
    win = {}
    for i, t in items:
        w = words(t)
        for j in range(len(w) - min(13, len(w)) + 1):
            if w:
                win.setdefault(tuple(w[j : j + 13]), set()).add(str(i))
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(k) for k in win}:
            for j in range(len(w) - n + 1):
                if x := win.get(tuple(w[j : j + n])):
                    hit.update(range(j, j + n))
                    found |= x
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def test_contamination_equals_brute_force(spark, duck, data):
    got = op7_decontaminate(spark, data)
    want = brute(duck.sql("SELECT doc_id, text FROM documents").fetchall(), duck.sql("SELECT item_id, text FROM benchmark").fetchall())
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def test_contamination_of_odd_rows_in_blocks(spark, odd, none):
    items = [("b", passage(2, 40)), ("a", "X"), (None, passage(3, 20)), ("c", None), ("d", ""), ("e", passage(1, 13)), ("a", "é")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    want = brute(docs, [("" if i is None else i, t) for i, t in items])
    for size in (1 << 20, 200):
        got = find_contamination(odd, bench, block_bytes=size, carry=["doc_id"]).collect()
        mine = [(r["doc_id"], r["decon_words"], r["decon_hit"], len(r["decon_items"]), hashlib.sha256(",".join(r["decon_items"]).encode()).hexdigest(), r["decon_hit"] > 0 and 20 * r["decon_hit"] >= r["decon_words"]) for r in got]
        assert sorted(mine, key=repr) == want
    kept = decontaminate(odd, bench)
    assert kept.columns == odd.columns and kept.count() == sum(not w[-1] for w in want) and {r["decon_words"] for r in kept.collect()} == {1}
    assert decontaminate(none, bench).count() == 0 and decontaminate(odd, bench.limit(0)).count() == odd.count()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


def test_tokens_equal_the_library(spark, duck, data, library, odd):
    texts = [t for (t,) in duck.sql("SELECT text FROM documents").fetchall()]
    texts += ["", " ", "<|endoftext|>", "a<|startoftext|>b <|ENDOFTEXT|>", "a" * 999, "I'm we'LL don't 123 ４５ ½ ΑΣ ΟΔΟΣ İ ǅ ﬁ ẞ", "a\x1cb\x85c d　e​g", "日本語 한국어 ไทย", "👩‍👩‍👧", "\x00\x7f", "é"]
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert Counter(load_vocabulary(vocabulary())).count(texts) == want
    got = count_tokens(odd, vocabulary(), limit=50).collect()
    for r in got:
        t = r["text"] or ""
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(t.encode()), n, n > 50)


def test_merging_is_rank_synchronous_over_ragged_rows():
    v = load_vocabulary(vocabulary())
    one = [merge_counts([t], v)[0] for t in (b"hello", b"a", b"zzzzzzz", b"the")]
    assert merge_counts([b"hello", b"a", b"zzzzzzz", b"the"], v).tolist() == one


ASSIGN = re.compile(r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def spans(t):
    s = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
    s += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    return sorted(s + [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32])


def test_secrets_equal_brute_force(spark, duck, data):
    docs = dict(duck.sql("SELECT doc_id, text FROM documents").fetchall())
    for r in op4_trigram_secrets(spark, data).collect():
        s = spans(docs[r["doc_id"]] or "")
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(x[1] == k for x in s) for k in range(3))
        text = ",".join(f"{k}:{a}:{b}" for a, _, k, b in s)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(r["spans"].split(","))


def test_secrets_in_odd_texts(spark, odd, none):
    rows = [(1, "password: secret: abcdefghij"), (2, None), (None, "é\U0001f600token=abcdefghi API_KEY = \"zzzzzzzzzz\""), (4, "AKIA" + "Z" * 20 + " " + "0" * 40), (4, "tOKEN=abcdefghijk " * 400), (5, "ſecret=aaaaaaaaaa KAKIA"), (6, "passwd'='12345678\ntoken:\x20\x20short")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = scan_secrets(df).collect()
    assert sorted(repr((r["doc_id"], [(s["start"], s["order"], s["kind"], s["end"]) for s in r["secret_spans"]])) for r in got) == sorted(repr((d, spans(t or ""))) for d, t in rows)
    assert scan_secrets(odd).count() == odd.count() and scan_secrets(none).count() == 0


def test_queries_of_rules():
    q = {r.kind: trigram_query(r.pattern) for r in RULES}
    assert q["access"] == ("and", "aki", "kia") and q["hex"] is True and q["assign"][0] == "or"
    assert {"tok", "oke", "ken"} <= trigrams_of(q["assign"])
    assert trigram_query("(ab|cd)ef") == ("or", ("and", "abe", "bef"), ("and", "cde", "def")) and trigram_query("a*b") is True
    assert trigram_query("(?:abc)+x?def") == ("and", "abc", "def")


def luhn(s):
    d = [int(c) for c in reversed(s) if c.isdigit()]
    return sum(d[::2] + [x * 2 - 9 * (x > 4) for x in d[1::2]]) % 10 == 0


def test_pseudonyms_keep_formats_and_links(spark):
    text = "mail ann.7@mail.example.com, +1 (359) 555-3724 or +1 359 555 3724; 4041894974608795 4041-8949-7460-8795 4041894974608796 1.2.3.4 999.1.1.1 1999-12-31 31.12.1999 31.02.1999 123-45-6789 GB82 WEST 1234 5698 7654 32"
    df = spark.createDataFrame([(1, text), (2, "again 4041894974608795 on 1999-12-31, (359) 555-3724 or 359-555-3724 or 359.555.3724."), (3, None), (4, "")], "doc_id long, text string")
    out = {r["doc_id"]: r for r in pii.pseudonymize(df, "k").collect()}
    new, w, v = out[1]["text"], text.split(), out[1]["text"].split()
    shape = lambda t: re.sub("[0-9]", "9", re.sub("[a-zA-Z]", "a", re.sub(r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9])", "address", t)))
    assert shape(new) == shape(text)
    assert all(0 <= int(x) <= 255 for x in v[w.index("1.2.3.4")].split(".")) and "1.2.3.4" not in new
    for gone in ("ann.7@", "555-3724", "4041894974608795", "1999-12-31", "123-45-6789", "WEST 1234"):
        assert gone not in new
    for stays in ("4041894974608796", "999.1.1.1", "31.02.1999", "@mail.example.com", "GB"):
        assert stays in new
    card, other = v[w.index("4041894974608795")], v[w.index("4041-8949-7460-8795")]
    assert luhn(card) and other.replace("-", "") == card and card in out[2]["text"]
    assert re.sub(r"\D", "", new[new.index("+1 (") :][:17]) == re.sub(r"\D", "", new.split(" or ")[1][:15])
    tail = re.sub(r"\D", "", new[new.index("+1 (") :][:17])[1:]
    assert re.sub(r"\D", "", out[2]["text"]).endswith(tail * 3) and out[2]["pii_counts"] == {"card": 1, "date": 1, "phone": 3}
    iso, dotted = v[w.index("1999-12-31")], v[w.index("31.12.1999")]
    assert "-".join(reversed(dotted.split("."))) == iso and iso in out[2]["text"]
    iban = new[new.index("GB") :].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    assert out[1]["pii_counts"] == {"email": 1, "phone": 2, "card": 2, "ip": 1, "date": 2, "ssn": 1, "iban": 1}
    assert (out[3]["text"], out[4]["text"], out[3]["pii_counts"]) == (None, "", {})
    assert pii.pseudonymize(df, "other").filter("doc_id = 1").first()["text"] != new


def test_account_numbers_end_where_their_country_says(spark):
    numbers = ["BE68 5390 0754 7034", "ES9121000418450200051332", "ES91 2100 0418 4502 0005 1332", "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947"]
    after = [" EUR", " 2024", " VAT", " 2024-05-17", " ABCD 4041894974608795", "", ", paid"]
    texts = [(i, f"to {n}{a}", n, a) for i, (n, a) in enumerate((n, a) for n in numbers for a in after)]
    for r in pii.pseudonymize(spark.createDataFrame(texts, "doc_id long, text string, n string, a string"), "k").collect():
        more = {" 2024-05-17": {"date": 1}, " ABCD 4041894974608795": {"card": 1}}.get(r["a"], {})
        assert r["pii_counts"] == {"iban": 1} | more, (r["n"], r["a"])
        assert r["n"] not in r["text"] and (more or r["text"].endswith(r["a"]))
        iban = r["text"][3 : 3 + len(r["n"])].replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def test_networks_are_permutations(spark):
    n = spark.range(189 * 773).select(pii.permute_number(F.col("id"), 189, 773, "k", "date").alias("p"))
    assert tuple(n.agg(F.min("p"), F.max("p"), F.count_distinct("p")).first()) == (0, 146096, 146097)
    for width in (1, 3, 4):
        t = spark.range(10**width).select(pii.permute_text(F.lpad(F.col("id").cast("string"), width, "0"), "k", "x").alias("p"))
        assert t.distinct().count() == 10**width


def test_pseudonyms_of_odd_rows(odd, none):
    out = pii.pseudonymize(odd, "k")
    assert out.count() == odd.count() and set(out.columns) == set(odd.columns) and pii.pseudonymize(none, "k").count() == 0
    assert dict(out.dtypes)["pii_counts"] == "map<string,int>"


# ---- personal data, worked out again in plain Python ---------------------------------------------------------------


def py_digest(key, kind, turn, value):
    return hashlib.sha256(f"{key}|{kind}|{turn}|{value}".encode()).hexdigest()


def py_number(x, a, b, key, kind):
    u, v, mu, mv = x // b, x % b, a, b
    for turn in range(1, 9):
        u, v, mu, mv = v, (u + int(py_digest(key, kind, turn, v)[:15], 16)) % mu, mv, mu
    return u * b + v


def py_text(t, key, kind):
    u, v = t[: len(t) // 2], t[len(t) // 2 :]
    for turn in range(1, 9):
        d, out = py_digest(key, kind, turn, v), ""
        for i, c in enumerate(u):
            low, n = (48, 10) if "0" <= c <= "9" else (97, 26) if "a" <= c <= "z" else (65, 26) if "A" <= c <= "Z" else (0, 0)
            out += chr(low + (ord(c) - low + int(d[2 * (i % 32) : 2 * (i % 32) + 2], 16)) % n) if n else c
        u, v = v, out
    return u + v


def py_like(original, plain, kept):
    rest = iter(plain)
    return "".join(next(rest) if re.fullmatch(kept, c) else c for c in original)


def py_mod97(t):
    return int("".join(str(int(c, 36)) for c in t[4:] + t[:4])) % 97


def py_date(m):
    import datetime as dt

    try:
        return dt.date.fromisoformat(m) if m[4] == "-" else dt.date(int(m[6:]), int(m[3:5]), int(m[:2]))
    except ValueError:
        return None


CODES = {"1", "7", *"20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()}


def py_pseudonym(m, key):
    import datetime as dt

    digits, whole = re.sub(r"\D", "", m), lambda p: re.fullmatch(p, m)
    if "@" in m:
        name, domain = m.split("@")
        plain = py_text(name.lower(), key, "email")
        return "email", "".join(p.upper() if "A" <= c <= "Z" else p for c, p in zip(name, plain)) + "@" + domain
    if whole(pii.IP) and all(int(x) < 256 for x in m.split(".")):
        n = py_number(int.from_bytes(bytes(map(int, m.split("."))), "big"), 65536, 65536, key, "ip")
        return "ip", ".".join(map(str, n.to_bytes(4, "big")))
    bare = m.replace(" ", "")
    if whole(pii.IBAN) and py_mod97(bare) == 1:
        body = py_text(bare[4:], key, "iban")
        return "iban", py_like(m, f"{bare[:2]}{98 - py_mod97(bare[:2] + '00' + body):02}{body}", "[A-Z0-9]")
    if m[0] == "+" or whole(pii.LOCAL_PHONE):
        code = next(digits[:n] for n in (1, 2, 3) if digits[:n] in CODES or n == 3) if m[0] == "+" else ""
        code += "0" if "(0)" in m else ""
        return "phone", py_like(m, code + py_text(digits[len(code) :], key, "phone"), "[0-9]")
    if whole(pii.DATE) and (day := py_date(m)):
        first = dt.date(1800, 1, 1)
        moved = first + dt.timedelta(py_number((day - first).days, 189, 773, key, "date"))
        return "date", moved.isoformat() if m[4] == "-" else moved.strftime(f"%d{m[2]}%m{m[2]}%Y")
    if whole(pii.SSN):
        area, group, serial = int(m[:3]), int(m[4:6]), int(m[7:])
        if 0 < area < 900 and area != 666 and group and serial:
            n = py_number(((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1, 898 * 99, 9999, key, "ssn")
            at = n // (99 * 9999) + 1
            return "ssn", f"{at + (at >= 666):03}-{n // 9999 % 99 + 1:02}-{n % 9999 + 1:04}"
    if whole(pii.CARD) and luhn(digits):
        payload = py_text(digits[:-1], key, "card")
        return "card", py_like(m, next(payload + c for c in "0123456789" if luhn(payload + c)), "[0-9]")
    return None, m


def py_pseudonymize(t, key):
    kinds = []

    def one(m):
        kind, value = py_pseudonym(m[0], key)
        kinds.append(kind)
        return value

    return re.sub(pii.PATTERN, one, t, flags=re.ASCII), {k: kinds.count(k) for k in kinds if k}


def test_pseudonyms_equal_a_plain_version(spark, duck):
    docs = duck.sql("SELECT doc_id, text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall()
    docs += [(-1, "+44 20 7946 0958 +44 (0)20 7946 0958 Ann.B@x.org ann.b@x.org 12/25/2020 03/04/2020 25.12.2020 0000-00-00 666-12-1234 +999 12 34 56 78")]
    got = {r["doc_id"]: r for r in pii.pseudonymize(spark.createDataFrame(docs, "doc_id long, text string"), "k").collect()}
    found = 0
    for d, t in docs:
        new, counts = (None, {}) if t is None else py_pseudonymize(t, "k")
        assert (got[d]["text"], got[d]["pii_counts"]) == (new, counts)
        found += len(counts)
    assert found > 50


def test_phones_and_addresses_are_linked_however_written(spark):
    texts = ["+1 415 555 2671", "+14155552671", "+1 (415) 555-2671", "(415) 555-2671", "415.555.2671", "+44 20 7946 0958", "+442079460958", "+44 (0)20 7946 0958", "Ann.B@x.org", "ann.b@x.org"]
    out = [r["text"] for r in pii.pseudonymize(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "k").orderBy("doc_id").collect()]
    digits = [re.sub(r"\D", "", t) for t in out]
    assert digits[0] == digits[1] == digits[2] == "1" + digits[3] and digits[3] == digits[4] != "4155552671"
    assert digits[5] == digits[6] and digits[7] == "440" + digits[5][2:] and digits[5][:2] == "44"
    assert out[8].lower() == out[9] != "ann.b@x.org" and (out[8][0].isupper(), out[8][4].isupper()) == (True, True)


def test_contamination_in_several_passes(spark, monkeypatch):
    """A benchmark of many blocks, an item that is a block by itself, and texts that many items share."""
    from marlstone.llm import decontaminate as D

    monkeypatch.setattr(D, "BIN_BYTES", 4000)
    items = [(f"i{i}", passage(70_000 + i, 5 + i % 90)) for i in range(600)] + [("long", passage(7, 9000)), *[(f"same{i}", passage(70_003, 8)) for i in range(40)]]
    long = items[600][1].split()
    docs = [(i, " ".join([passage(90_000 + i, 50), items[i * 7 % 600][1], items[i * 11 % 600][1], passage(95_000 + i, 30), *long[i * 40 : i * 40 + i % 30]])) for i in range(200)]
    docs += [(500, None), (501, ""), (502, items[600][1])]
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = find_contamination(spark.createDataFrame(docs, "doc_id long, text string"), bench, block_bytes=30_000).collect()
    mine = [(r["doc_id"], r["decon_words"], r["decon_hit"], len(r["decon_items"]), hashlib.sha256(",".join(r["decon_items"]).encode()).hexdigest(), r["decon_hit"] > 0 and 20 * r["decon_hit"] >= r["decon_words"]) for r in got]
    assert sorted(mine, key=repr) == brute(docs, items)


def test_secrets_in_a_text_of_many_matches(spark):
    t = " ".join(f"token=abcdefg{i} secret:x{i % 7}" + "é" * (i % 3) for i in range(3000))
    got = scan_secrets(spark.createDataFrame([(1, t)], "doc_id long, text string")).first()
    assert [(s["start"], s["order"], s["kind"], s["end"]) for s in got["secret_spans"]] == spans(t)


def test_tokens_of_an_empty_table(spark, none):
    assert count_tokens(none, vocabulary(), limit=50).count() == 0
