import base64
import bz2
import gzip
import hashlib
import lzma
import re
import zlib
from urllib.parse import quote

import zstandard

import __spark_entry__ as E
from tessera.llm import secret_scan as S
from llm_helpers import AWKWARD, clash, frame, texts_of

KEYS = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def base(text):
    found = [("assign", *m.span()) for m in re.finditer(KEYS, text, re.I | re.A) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda x: (x[1], ("assign", "access", "hex").index(x[0])))


def joined(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def test_query_equals_plain_patterns(spark, sf):
    texts = dict(texts_of(spark, sf))
    rows = E.queries()["op5_secret_scan"](spark, sf).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        want = base(texts[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(joined(want).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == x for k, _, _ in want) for x in S.KINDS]
        assert set(joined(want).split(",")) <= set(r.spans.split(","))


def layers():
    s = "password = hunter2hunter2"
    b = base64.b64encode
    yield b(s.encode()).decode(), True
    yield b(b(s.encode())).decode(), True
    yield b(gzip.compress(s.encode())).decode(), True
    yield b(gzip.compress(bz2.compress(zlib.compress(s.encode())))).decode(), True
    yield base64.urlsafe_b64encode(b"\xc3\xbf\xc3\xbe " + s.encode()).decode().rstrip("="), True
    yield quote(s, safe=""), False
    yield quote(quote(s, safe=""), safe=""), False
    yield "".join(f"\\u{ord(c):04x}" for c in s), False
    yield quote("".join(f"\\u{ord(c):04x}" for c in s)), False
    yield quote(b(zlib.compress(s.encode())).decode(), safe=""), False


def test_every_layer_is_unwrapped_and_mapped():
    for run, whole in layers():
        text = f"é see <{run}> here"
        inside, spans, bombs = S.find_spans(text)
        new = [x for x in spans if x not in inside]
        assert len(new) >= 1 and not bombs, run
        for k, s, e in new:
            assert k == "assign" and 7 <= s < e <= 7 + len(run)
        if whole:
            assert new == [("assign", 7, 7 + len(run))]
        assert run not in S.redact(text) and S.redact(text).startswith("é see <")


def test_equal_layers_keep_every_span():
    once = base64.b64encode(b"password = hunter2hunter2").decode()
    twice = base64.b64encode(once.encode()).decode()
    text = f"<{once}> <{once}>\n<{twice}> <{twice}>"
    spans = S.find_spans(text)[1]
    assert {(m.start(), m.end()) for m in re.finditer("[A-Za-z0-9+/=]{16,}", text)} <= {(s, e) for _, s, e in spans}
    assert S.redact(text) == "<[SECRET]> <[SECRET]>\n<[SECRET]> <[SECRET]>"


SECRET = b"password = hunter2hunter2"


def test_odd_bytes_cost_no_other_match():
    for odd in ("\u00a0", "\u3000", "\u200b", "\ufeff", "\f", "\0"):
        run = base64.b64encode(SECRET + odd.encode()).decode()
        assert S.redact(f"<{run}>") == "<[SECRET]>", ascii(odd)
    for raw in (b"\xff " + SECRET, SECRET + b" \xc3", b"caf\xe9 " + SECRET):
        assert S.redact(f"<{base64.b64encode(raw).decode()}>") == "<[SECRET]>"
        assert S.redact(f"<{base64.b64encode(gzip.compress(raw)).decode()}>") == "<[SECRET]>"
        assert {k for k, _, _ in S.find_spans("".join(f"%{b:02X}" for b in raw))[1]} == {"assign"}
        assert {k for k, _, _ in S.find_spans("".join(f"\\x{b:02x}" for b in raw))[1]} == {"assign"}
    assert S.find_spans("".join(f"\\u{ord(c):04x}" for c in SECRET.decode()) + "\\ud800")[1]


def test_every_member_is_read():
    for pack in (gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.compress):
        for raw in (pack(b"nothing here ") + pack(SECRET), pack(b"pass") + pack(b"word=hunter2hunter2"),
                    pack(b"\0\xff" + pack(SECRET))):
            assert S.redact(f"<{base64.b64encode(raw).decode()}>") == "<[SECRET]>", pack


def test_streams_in_escapes_are_inflated():
    for pack in (gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.compress):
        raw = pack(SECRET)
        for run in ("".join(f"%{b:02x}" for b in raw), "".join(f"\\x{b:02x}" for b in raw), quote(raw, safe=""),
                    "".join(f"\\u{b:04x}" for b in raw), "".join(f"&#{b};" for b in raw)):
            assert {k for k, _, _ in S.find_spans(f"<{run}>")[1]} == {"assign"}, (pack, run)
            assert run not in S.redact(f"<{run}>") and S.redact(f"<{run}>").startswith("<[SECRET]")


def small_slices(monkeypatch):
    for name, size in (("MAX_INFLATED", 3000), ("_SLICE", 1500), ("_OVERLAP", 600), ("_OUT", 100), ("_IN", 64)):
        monkeypatch.setattr(S, name, size)


def kinds_of(text):
    return {k for k, _, _ in S.find_spans(text)[1]}


def test_large_streams_are_scanned(monkeypatch):
    small_slices(monkeypatch)
    for filler in (b"a word, ", b"A.", b"x"):
        for before in range(2950, 4050, 13):
            raw = (filler * before)[:before - 1] + b" " + SECRET + b" " + filler * 500
            spans, bombs = S.find_spans(f"<{base64.b64encode(gzip.compress(raw)).decode()}>")[1:]
            assert {k for k, _, _ in spans} == {"assign"} and bombs == 1, (filler, before)


def test_spaces_of_any_length_in_large_streams(monkeypatch):
    small_slices(monkeypatch)
    raw = b"A." * 2000 + b"password" + b" " * 5000 + b"=" + b" " * 3000 + b"hunter2hunter2" + b"A." * 2000
    assert kinds_of(f"<{base64.b64encode(gzip.compress(raw)).decode()}>") == {"assign"}


def test_streams_that_outlast_their_slice_are_followed(monkeypatch):
    """Nested streams of several slices, plain and below base64 and escapes, with the secret at their end."""
    import random
    small_slices(monkeypatch)
    rng = random.Random(3)
    noise = bytes(rng.randrange(256) for _ in range(9000))
    wraps = {"plain": bytes, "base64": base64.b64encode, "lines": base64.encodebytes,
             "percent": lambda b: "".join(f"%{x:02x}" for x in b).encode(),
             "twice": lambda b: base64.b64encode(base64.b64encode(b)),
             "code points": lambda b: "".join(f"\\u{x:04x}" for x in b).encode()}
    for pack in (gzip.compress, bz2.compress, zstandard.compress):
        inner = pack(noise + b" " + SECRET)
        for name, wrap in wraps.items():
            for before in (0, 1001, 3217):
                outer = b"A." * (before // 2) + b"<" + wrap(inner) + b">" + b"B." * 100
                assert kinds_of(f"<{base64.b64encode(gzip.compress(outer)).decode()}>") >= {"assign"}, (pack, name, before)
                clean = b"A." * (before // 2) + b"<" + wrap(pack(b"A." * 3000)) + b">" + b"B." * 1000
                assert kinds_of(f"<{base64.b64encode(gzip.compress(clean)).decode()}>") == set()
    deep = gzip.compress(b"A." * 500 + gzip.compress(b"B." * 900 + gzip.compress(noise + SECRET) + noise) + noise)
    assert kinds_of(f"<{base64.b64encode(deep).decode()}>") >= {"assign"}


BOMB = """
import base64, gzip, io, resource, sys, zlib
sys.path.insert(0, sys.argv[1])
from tessera.llm import secret_scan as S

def packed(parts, level=9):
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return b"".join([c.compress(p) for p in parts]) + c.flush()

size = int(sys.argv[2])
block = b"A." * (1 << 19)
once = packed([block] * (size >> 20) + [b" password = hunter2hunter2"])
stored = packed([once[i:i + 65536] for i in range(0, len(once), 65536)] + [block] * (size >> 20), 0 if len(once) > 1 << 19 else 9)
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
for raw in (once, stored):
    base, spans, bombs = S.find_spans("<" + base64.b64encode(packed([raw])).decode() + ">")
    assert {k for k, _, _ in spans} == {"assign"} and bombs >= 1, (spans, bombs)
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024, before // 1024)
"""


def test_streams_without_a_break_take_bounded_memory():
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", BOMB, root, str(200 << 20)], capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    assert int(out.stdout.split()[0]) < 1000


def test_payloads_behind_other_characters():
    run = base64.urlsafe_b64encode(SECRET + b", and more").decode().rstrip("=")
    packed = base64.b64encode(zlib.compress(SECRET)).decode()
    for before in ("https://host.example/cb/", "key-", "id_", "a+", "x/y/", "x", "xy", "xyz", "a-longer-name_of-it/"):
        for r in (run, packed):
            for after in ("", " tail", "/next"):
                out = S.redact(f"<{before}{r}{after}>")
                assert "[SECRET]" in out and r.rstrip("=")[4:-4] not in out, (before, r, after)
    assert S.redact(f"<https://host.example/callback/{run}>") == "<https://host.example/callback/[SECRET]>"
    assert S.redact(f"<{run}A>") != f"<{run}A>" and S.redact(f"<{run}AA>") != f"<{run}AA>"


def test_wrapped_runs_are_joined():
    raw = b"some lines before it, " * 3 + SECRET + b" and after"
    for pack in (bytes, gzip.compress, bz2.compress):
        for width in (10, 22, 64, 76):
            for newline in ("\n", "\r\n", "\n    "):
                run = base64.b64encode(pack(raw)).decode()
                body = newline.join(run[i:i + width] for i in range(0, len(run), width))
                text = f"data:\n{body}\n.end"
                kinds = {k for k, s, e in S.find_spans(text)[1] if 6 <= s < e <= 6 + len(body)}
                assert kinds == {"assign"}, (pack, width, newline)


def test_escapes_map_exactly():
    text = "pass%77ord=abcdefgh tail"
    assert S.find_spans(text)[1] == {("assign", 0, 19)}
    assert S.redact(text) == "[SECRET] tail"


def test_cycles_and_bombs_end():
    assert S.find_spans("%2525252525 \\u005cu005c" * 50)[2] == 0
    bomb = base64.b64encode(gzip.compress(b"\0" * (S.MAX_INFLATED + 1))).decode()
    assert S.find_spans(bomb)[2] == 1


def test_overlapping_matches_are_consumed():
    text = "api_key: token :abcdefgh secret=token=abcdef Token'='ABCDEFG AKIA" + "A" * 15
    assert S.scan(text) == base(text) or sorted(S.scan(text)) == sorted(base(text))


def test_awkward_rows(spark):
    rows = S.scan_documents(clash(frame(spark, AWKWARD))).collect()
    assert len(rows) == len(AWKWARD) and rows[1].n_assign == 0 and rows[0].spans == ""
    assert S.scan_documents(frame(spark, AWKWARD).limit(0)).collect() == []
    text = "token=abcdefgh and 0123456789abcdef0123456789"
    out = S.redact_documents(clash(frame(spark, [text, None, "clean"]))).orderBy("doc_id").collect()
    assert [r.text for r in out] == ["[SECRET] and [SECRET]", None, "clean"]
    assert [r.n_chars for r in out] == [21, None, 5] and out[0].score == "x"
