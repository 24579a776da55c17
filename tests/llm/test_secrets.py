import base64
import gzip
import hashlib
import random
import re
import time
import urllib.parse
import zlib

import pytest

from threadloom.llm import secrets

SECRET = 'token = "abcdefghij0123456789XYZ"'
WORD = "(?:password|passwd|secret|token|api_?key)"


def plain(text):
    """The stated patterns, applied as they stand."""
    found = []
    for m in re.finditer(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                         r"([A-Za-z0-9+/_.=-]+)", text, re.I | re.A):
        if len(m[2]) >= 12:
            found.append(("assign", *m.span()))
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found, key=lambda f: (f[1], secrets.KINDS.index(f[0])))


def check(docs):
    texts = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    wanted = []
    for key, text in texts:
        base = plain(text)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        wanted.append((str(key), *(sum(f[0] == k for f in base) for k in secrets.KINDS),
                       hashlib.sha256(joined.encode()).hexdigest()))
    found = secrets.secret_scan(docs).collect()
    assert sorted((str(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256)
                  for r in found) == sorted(wanted)
    for r in found:
        # The spans hold at least as many as the base has.
        assert len(r.spans.split(",") if r.spans else []) >= r.n_assign + r.n_access + r.n_hex
    return found


def test_base_equals_plain_patterns(test_documents):
    check(test_documents)


def test_base_equals_plain_patterns_on_random_text():
    rng = random.Random(3)
    pieces = ["token", "PassWord", "API_KEY", "apikey", "ſecret", "toKen", "=", ":", " ", '"', "'",
              "AKIA", "ABCDEFGH1234", "0123456789abcdef", "abc", "é", "\n", "-._/+", "zz" * 7]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 14)))
        assert secrets.scan(text) == plain(text)
        base, every = secrets.findings(text)
        assert set(base) <= {f[:3] for f in every}


def encodings(text):
    b64 = base64.b64encode(text.encode()).decode()
    yield b64
    yield base64.urlsafe_b64encode((text + "?>~?>~").encode()).decode()
    yield base64.b64encode(b64.encode()).decode()
    yield urllib.parse.quote(b64, safe="")
    yield urllib.parse.quote(urllib.parse.quote(text))
    yield "".join(f"%{b:02X}" for b in text.encode())
    yield "".join(f"\\u{ord(c):04x}" for c in text)
    yield "".join(f"&#{ord(c)};" for c in text)
    yield "".join(f"\\x{ord(c):02x}" for c in text)
    yield text.encode().hex()
    yield base64.b64encode(gzip.compress(text.encode())).decode()
    yield base64.b64encode(zlib.compress(text.encode())).decode()
    yield zlib.compress(text.encode()).hex()


@pytest.mark.parametrize("encoded", list(encodings(SECRET)))
def test_nested_layers_are_found_within_their_piece(encoded):
    text = f"é before {encoded} after"
    spans = [f for f in secrets.findings(text)[1] if f[0] == "assign"]
    assert spans, "not found"
    for _, a, b, path in spans:
        assert path != "text" and 9 <= a < b <= 9 + len(encoded)


@pytest.mark.parametrize("before", ["data=", "https://h/x?q=", "https://host/path/to/", "KEY_OF_16_LETTERS="])
@pytest.mark.parametrize("pack", [bytes, gzip.compress, zlib.compress])
def test_base64_after_a_sign_is_found(before, pack):
    encoded = base64.b64encode(pack(SECRET.encode())).decode()
    text = f"é {before}{encoded} after"
    spans = [f for f in secrets.findings(text)[1] if f[0] == "assign" and f[3] != "text"]
    start = 2 + len(before)
    assert any(start <= a < b <= start + len(encoded) for _, a, b, _ in spans)


@pytest.mark.parametrize("before", ["", "data=", "data: ", "x/"])
@pytest.mark.parametrize("after", ["", "\n", "\nend of it", " end"])
@pytest.mark.parametrize("pack", [bytes, gzip.compress, zlib.compress])
@pytest.mark.parametrize("newline", ["\n", "\r\n", "\n    "])
def test_wrapped_base64_is_found(before, after, pack, newline):
    rng = random.Random(4)
    filler = " ".join(str(rng.random()) for _ in range(12))
    for shift in range(0, 60, 7):
        data = pack((filler + "." * shift + " " + SECRET + " " + filler).encode())
        encoded = base64.encodebytes(data).decode().rstrip("\n").replace("\n", newline)
        text = before + encoded + after
        spans = [f for f in secrets.findings(text)[1] if f[0] == "assign" and f[3] != "text"]
        assert any(b - a > 76 and b <= len(before + encoded) + 4 for _, a, b, _ in spans)


RAW = SECRET.encode()


@pytest.mark.parametrize("data", [
    gzip.compress(gzip.compress(RAW)), gzip.compress(zlib.compress(RAW)),
    zlib.compress(gzip.compress(zlib.compress(RAW))),
    gzip.compress(b"first member") + gzip.compress(RAW),
    gzip.compress(gzip.compress(b"first") + gzip.compress(RAW)),
    gzip.compress(b"\0\xff" + RAW + b"\x1b\x0c"), gzip.compress(RAW) + b"no member",
    gzip.compress(RAW)[:-6], gzip.compress(RAW)[:-8] + b"\1" * 8,
    b"\x00\xfe" + RAW, RAW + b"\x0c\x1b\xff", b"x^2 is no zlib; " + RAW,
    b"\0" + base64.b64encode(gzip.compress(RAW)) + b"\0",
])
def test_packed_and_binary_layers_are_read_to_the_end(data):
    for encoded in (base64.b64encode(data).decode(), data.hex()):
        spans = [f for f in secrets.findings(f"é before {encoded} after")[1] if f[0] == "assign"]
        assert (9, 9 + len(encoded)) in {(a, b) for _, a, b, _ in spans}


def test_a_secret_split_by_an_escape_maps_to_its_span():
    assert secrets.findings("x AKIA%41BCDEFGHIJKLMNOPQ y")[1] == [("access", 2, 25, "text>url")]


def test_cycles_and_bombs_end():
    assert secrets.findings("%2525%2525 %25 &#38;#38;#38; \\u005cu005c")[0] == []
    bomb = base64.b64encode(zlib.compress(b"a" * 50_000_000)).decode()
    assert all(f[3] == "text" for f in secrets.findings(bomb)[1])


@pytest.mark.parametrize("before", ["", "%ff", "%80%C3", "%00"])
def test_escapes_that_are_no_text_leave_the_others_readable(before):
    text = f"é {before}{''.join(f'%{b:02X}' for b in RAW)} after"
    spans = [f for f in secrets.findings(text)[1] if f[0] == "assign" and f[3] != "text"]
    assert spans and all(2 <= a < b <= len(text) - 6 for _, a, b, _ in spans)


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress])
def test_packed_data_in_url_escapes_are_unpacked(pack):
    for encoded in (urllib.parse.quote(pack(RAW), safe=""),
                    "".join(f"%{b:02X}" for b in pack(RAW))):
        spans = [f for f in secrets.findings(f"q={encoded} after")[1] if f[0] == "assign"]
        assert (2, 2 + len(encoded)) in {(a, b) for _, a, b, _ in spans}


def slow(text):
    """Every piece after every slash of every run, decoded by itself: names of secrets found."""
    waiting, seen, found = [text], set(), set()
    while waiting:
        layer = waiting.pop()
        if layer in seen:
            continue
        seen.add(layer)
        found |= {layer[a:b] for _, a, b in plain(layer)}
        for m in re.finditer(r"[A-Za-z0-9+/]{16,}", layer):
            for at in [0, *(i + 1 for i, c in enumerate(m[0]) if c == "/")]:
                piece = m[0][at:]
                data = secrets._from_base64(piece)
                for unpack in (bytes, gzip.decompress, zlib.decompress):
                    try:
                        waiting.append(unpack(data).decode("utf-8"))
                    except (UnicodeDecodeError, OSError, EOFError, zlib.error):
                        pass
        waiting += [urllib.parse.unquote(layer)]
        for m in re.finditer("(?:[0-9a-f]{2}){16,}", layer):
            try:
                waiting.append(bytes.fromhex(m[0]).decode("utf-8"))
            except UnicodeDecodeError:
                pass
    return found


def test_nothing_is_missed_that_a_slow_worklist_finds():
    rng = random.Random(9)
    ways = [lambda d: base64.b64encode(d), lambda d: d.hex().encode(),
            lambda d: urllib.parse.quote(d).encode(), lambda d: b"x/y/" + base64.b64encode(d),
            lambda d: base64.b64encode(gzip.compress(d)),
            lambda d: base64.b64encode(zlib.compress(d)), lambda d: b"some words " + d + b" more"]
    for round_ in range(150):
        secret = f"token={''.join(rng.choice('abcXYZ0189') for _ in range(20))}"
        data = secret.encode()
        for _ in range(rng.randint(1, 4)):
            data = rng.choice(ways)(data)
        text = data.decode()
        wanted = {w for w in slow(text) if w.startswith("token")}
        spans = [f for f in secrets.findings(text)[1] if f[0] == "assign"]
        if wanted:
            assert spans, (round_, text)


def test_time_is_linear_in_base64_with_slashes():
    rng = random.Random(10)
    letters = base64.b64encode(rng.randbytes(1_500_000)).decode()

    def seconds(n):
        text = f"data: {letters[:n]} end, {base64.b64encode(RAW).decode()}"
        start = time.process_time()
        assert [f for f in secrets.findings(text)[1] if f[0] == "assign"]
        return time.process_time() - start

    seconds(10_000)
    small, large = seconds(200_000), seconds(2_000_000)
    assert large < 25 * small + 0.5


def test_odd_rows(documents, odd_rows):
    check(documents(*odd_rows, (50, SECRET), (50, SECRET), (51, "AKIA" + "Q" * 14)))


def test_empty_table(documents):
    assert secrets.secret_scan(documents().filter("false")).collect() == []
