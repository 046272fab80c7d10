import hashlib
import re

from tidemark.llm import secret_scan as S

PATTERNS = [
    ("assign", re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
]


def brute(text):
    out = []
    for rank, (kind, pattern, group, least) in enumerate(PATTERNS):
        out += [(m.start(), rank, f"{kind}:{m.start()}:{m.end()}") for m in pattern.finditer(text or "") if len(m[group]) >= least]
    return [x[2] for x in sorted(out)]


TEXTS = [
    None, "", "nothing here", "password=short", 'TOKEN: "abcdef" and pass', "password: token: abcdef123", "é𝄞 secret = Zz9/+_.= x",
    "AKIA" + "A" * 16, "AKIA" + "B" * 15, "x AKIAAKIA" + "1" * 20, "0123456789abcdef" * 3, "f" * 24 + " " + "f" * 23,
    "api_key=" + "a" * 40 + " apikey:'deadbeefdeadbeefdeadbeef'", "token=token=abcdefgh", "ſecret=abcdefgh passwd=AKIA" + "Z" * 20,
    "token=abcdef1 " * 3000,
]


def test_matches_brute_force(frame):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, TEXTS[4]), (3, TEXTS[4]), (3, TEXTS[4]), (3, "other")]
    got = S.digest(S.scan(frame(rows))).collect()
    want = []
    for doc, t in rows:
        spans = brute(t)
        joined = ",".join(spans)
        count = [sum(s.startswith(k + ":") for s in spans) for k in ("assign", "access", "hex")]
        want.append((doc, *count, hashlib.sha256(joined.encode()).hexdigest(), joined))
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))


def test_no_python_in_the_plan(frame, capsys):
    S.digest(S.scan(frame([(1, TEXTS[4])]))).explain("formatted")
    text = capsys.readouterr().out
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


def test_only_unseen_pairs_are_scanned(spark, frame, tmp_path):
    path = str(tmp_path / "ledger")
    S.scan(frame([(1, TEXTS[4]), (2, TEXTS[4]), (3, "x")]), ledger_path=path).count()
    assert spark.read.parquet(path).count() == 2
    again = S.scan(frame([(7, TEXTS[4]), (8, TEXTS[6])]), ledger_path=path).collect()
    assert spark.read.parquet(path).count() == 3 and all(len(r.spans) == 1 for r in again)
    rules = (S.Rule("assign", 2, S.RULES[0].pattern, 2, 3), *S.RULES[1:])
    S.scan(frame([(9, "token=abc"), (7, TEXTS[4])]), ledger_path=path, rules=rules).count()
    rows = {bytes(r.blob): set() for r in spark.read.parquet(path).collect()}
    for r in spark.read.parquet(path).collect():
        rows[bytes(r.blob)] |= set(r.todo)
    assert rows[hashlib.sha256(TEXTS[4].encode()).digest()] == {"assign@1", "assign@2", "access@1", "hex@1"}
    assert rows[hashlib.sha256(TEXTS[6].encode()).digest()] == {"assign@1", "access@1", "hex@1"}


def test_redaction(spark):
    rows = [(1, "é token=0123456789abcdef01234567 ok", 30), (2, "clean", 5), (3, None, None), (3, "AKIA" + "A" * 16 + "!", 21)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").withColumnRenamed("n_chars", "n_chars")
    got = {(r.doc_id, r.text, r.n_chars) for r in S.redact(docs).collect()}
    assert got == {(1, "é [SECRET] ok", 13), (2, "clean", 5), (3, None, None), (3, "[SECRET]!", 9)}


def test_empty_table(frame):
    assert S.scan(frame([])).count() == 0 and S.redact(frame([]), length=None).count() == 0
