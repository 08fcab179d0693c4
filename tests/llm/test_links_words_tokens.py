"""URL verdicts, spelling variants and token alignment against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from shelfcast.llm import align, queries, spelling, urls
from shelfcast.llm import words as W

A_PATH, B_PATH = queries.tokenizer_path(), queries.tokenizer_path("piece_bpe_32k.model")


# --- URL verdicts ---------------------------------------------------------------------------------


def brute_verdicts(rows, rules, rounds=urls.ROUNDS):
    """(id, host, path, rule, verdict, trust, distrust) by plain loops."""
    parsed = []
    for page, url, html in rows:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        parsed.append((page, host, path, max(fit, key=lambda r: len(r.name), default=None), html))
    seeds, links = defaultdict(Counter), Counter()
    for _, host, _, rule, html in parsed:
        if rule and host:
            seeds["trust" if rule.verdict == "allow" else "distrust"][host] += 1
        targets = {"".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in re.findall(urls.LINK, html or "")}
        for target in targets - {host}:
            links[host, target] += bool(host)
    mass = {}
    for kind in ("trust", "distrust"):
        arcs = [((s, d) if kind == "trust" else (d, s), w) for (s, d), w in links.items() if w]
        out = Counter()
        for (a, _), w in arcs:
            out[a] += w
        total = sum(seeds[kind].values())
        base = {h: (urls.UNITS // total) * n * (100 - urls.DAMPING) // 100 for h, n in seeds[kind].items()}
        now = Counter(base)
        for _ in range(rounds):
            after = Counter(base)
            for (a, b), w in arcs:
                after[b] += (now[a] // out[a]) * w * urls.DAMPING // 100
            now = after
        mass[kind] = now
    found = []
    for page, host, path, rule, _ in parsed:
        t, d = mass["trust"][host], mass["distrust"][host]
        verdict = rule.verdict if rule else ("block" if d * (100 - urls.LIMIT) > t * urls.LIMIT else "allow")
        found.append((page, host, path, rule and rule.name, verdict, t, d))
    return sorted(found, key=repr)


def pages(spark, rows):
    queries.ready(spark)
    full = [(*r, "x", "y", 1) for r in rows]
    return spark.createDataFrame(full, "page_id long, url string, html string, host string, rule string, trust int").repartition(3)


def linked_pages(seed=0, count=300):
    """A web of hosts with cycles, hubs and a host with a third of all pages."""
    rng = random.Random(seed)
    hosts = ["hot.example.net", *(f"h{i}.example.{rng.choice(['com', 'org', 'net', 'info'])}" for i in range(30))]
    rows = []
    for page in range(count):
        host = hosts[0] if page % 3 == 0 else rng.choice(hosts)
        anchors = [f'<p><a class="k" href="//{rng.choice(hosts).upper()}/x">t</a>', "<A HREF='https://" + rng.choice(hosts) + "?q=1'>", '<a href="/here">', '<link href="//no.example.org">']
        rows.append((page, f"https://{host}/{rng.choice(['en', 'de', 'fr', ''])}/{page}", "".join(rng.sample(anchors, 3))))
    return rows


def judged(found):
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_urls_against_loops(spark):
    rows = linked_pages()
    found = judged(urls.judge(pages(spark, rows), queries.URL_RULES))
    assert found == brute_verdicts(rows, queries.URL_RULES)
    by_method = [r for r in found if r[3] is None]
    assert {r[4] for r in by_method} == {"allow", "block"}


def test_trust_and_distrust_travel(spark):
    """A host that links to a blocked one is blocked, one that an allowed host links to is not."""
    rules = [urls.Rule("good.org", "/", "allow"), urls.Rule("bad.net", "/", "block")]
    link = '<a href="http://{}/">'
    rows = [
        (1, "http://good.org/a", link.format("friend.info")), (2, "http://bad.net/a", None), (3, "http://friend.info/", ""),
        (4, "http://spam.info/", link.format("bad.net")), (5, "http://ring.info/", link.format("spam.info")), (6, "http://alone.info/", "<a href='/x'>"),
    ]
    found = {r.id: r.verdict for r in urls.judge(pages(spark, rows), rules).collect()}
    assert found == {1: "allow", 2: "block", 3: "allow", 4: "block", 5: "block", 6: "allow"}
    more = spark.createDataFrame([("friend.info", "SPAM.info", 50), ("a", None, 3), ("alone.info", "bad.net", 1)], "src string, dst string, w int")
    found = {r.id: r.verdict for r in urls.judge(pages(spark, rows), rules, links=more).collect()}
    assert found[6] == "block" and found[3] == "allow"


def test_urls_odd_rows(spark):
    rows = [
        (1, None, None), (2, "", ""), (3, "no scheme", "<a href='//x.net/'>"), (4, "http://", "<a href=//x.net>"), (None, "ftp://EXAMPLE.net", None),
        (5, "http://x.example.net/en/\nline?q://z/en/", "<a \n href = \"HTTPS://Y.org:80/\">"), (5, "http://x.example.net/en/", None), (6, "://net/", "<a " * 2000),
        (7, "http://netnet/x", None), (8, "http://net#/", None), (8, "http://net#/", None), (9, "http://a.b/" + "p" * 100_000, "<a href='//long.org'>" * 20_000),
    ]
    assert judged(urls.judge(pages(spark, rows), queries.URL_RULES)) == brute_verdicts(rows, queries.URL_RULES)
    assert urls.judge(pages(spark, rows).limit(0), queries.URL_RULES).count() == 0


# --- Spelling variants ----------------------------------------------------------------------------


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_spelling(rows, noise=97, least=3):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if noise and h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 5
    counts = {w: n for w, n in counts.items() if n >= least}
    form, near = {}, {}
    for w, n in counts.items():
        others = [x for x in counts if abs(len(x) - len(w)) < 2 and x != w and one_edit(w, x)]
        near[w] = len(others)
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    rows = []
    for w, n in counts.items():
        end = w
        while form[end]:
            end = form[end]
        rows.append((w, form[w], end, n, near[w], counts[form[w]] if form[w] else None))
    return sorted(rows, key=repr)


def misspelt(seed=0):
    rng = random.Random(seed)
    letters = "abcdeéñÀ\u00d7z"
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(4, 12))) for _ in range(60)]
    text = []
    for word in base * 6:
        for _ in range(rng.choice([1, 2, 5])):
            text.append(word)
        at, kind = rng.randrange(len(word)), rng.randrange(3)
        text += [word[:at] + ("" if kind == 0 else rng.choice(letters) + (word[at:] if kind == 1 else word[at + 1 :]))] * 2
    text += ["chained"] * 3 + ["chaine"] * 9 + ["chain"] * 40  # a form of a form
    rng.shuffle(text)
    return [(k, rng.choice([" ", "-", "\n", "1"]).join(text[k::40]).title() if k % 7 == 0 else " ".join(text[k::40])) for k in range(40)]


def got_spelling(found):
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize("noise", [0, 5, 97])
def test_spelling_against_pairs(spark, make, noise):
    rows = misspelt(noise)
    want = brute_spelling(rows, noise)
    assert got_spelling(spelling.variants(make(rows), noise=noise)) == want
    assert any(r[1] and r[2] != r[1] for r in want) and any(r[1] is None and r[4] for r in want)


def test_spelling_large_blocks(spark, make, monkeypatch):
    """Words that share one half all meet in one block: dealt again in finer parts, and in tiles."""
    rng = random.Random(5)
    words = {"preface" + "".join(rng.choice("abc") for _ in range(rng.choice([6, 7]))) for _ in range(1500)}
    rows = [(k, " ".join(w for w in sorted(words) for _ in range(3 + zlib.crc32(w.encode()) % 9))) for k in range(2)]
    want = brute_spelling(rows, 0)
    monkeypatch.setattr(spelling, "TILE", 64)
    for large in (40, 100_000):
        monkeypatch.setattr(spelling, "LARGE", large)
        assert got_spelling(spelling.variants(make(rows))) == want
    monkeypatch.setattr(spelling, "LARGE", 40)
    assert len(spelling._blocks(spark.createDataFrame([(w, 3) for w in words], "word string, n long"))) > 1


def test_spelling_odd_rows(make, odd_rows):
    rows = [*odd_rows, *((i, "Straße straßE strasse straße Straße " * 3 + "x" * 50_000 + " " + "x" * 50_001) for i in (20, 21, 22))]
    assert got_spelling(spelling.variants(make(rows), noise=97)) == brute_spelling(rows)
    assert spelling.variants(make(rows[:1])).count() == 0
    assert spelling.variants(make(rows).limit(0)).count() == 0


def test_run_checksums():
    text = "ab " + "Z" * 200 + " é×÷ñ q" + "Y" * 63 + " c" + "d" * 64
    data, offsets = W.plain(__import__("pyarrow").array([text]))
    block = spelling.letter_runs(data, offsets)
    runs = re.findall("[A-Za-z\u00c0-\u00ff]+", text)
    assert [w.decode() for w in block.texts(np.arange(len(block)))] == runs
    got = spelling.run_checksums(block, np.arange(len(block)), np.full(len(block), zlib.crc32(b"7:"), np.uint32))
    lower = lambda w: "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
    assert got.tolist() == [zlib.crc32(f"7:{lower(w)}".encode()) for w in runs]


# --- Token alignment ------------------------------------------------------------------------------


def brute_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    left = Tokenizer.from_file(A_PATH)
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    stand = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    found, holders = [], Counter()
    for doc, text in rows:
        a = left.encode(" " + text, add_special_tokens=False).ids if text else []
        b = right.encode(text) if text else []
        bytes_a = [bytes(stand[c] for c in left.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(right.id_to_piece(i)[3:5], 16)]) if right.is_byte(i) else right.id_to_piece(i).replace("\u2581", " ").encode() for i in b]
        whole = (" " + text).encode() if text else b""
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            a, b, bytes_a, bytes_b = [], [], [], []
        ends = [np.cumsum([len(x) for x in side]).tolist() for side in (bytes_a, bytes_b)]
        links, groups, i, j, held = [], [], 0, 0, ([], [])
        while i < len(a):
            links.append((a[i], b[j]))
            x, y = ends[0][i], ends[1][j]
            if x <= y:
                held[0].append(a[i])
                i += 1
            if y <= x:
                held[1].append(b[j])
                j += 1
            if x == y:
                groups.append("|".join(",".join(map(str, side)) for side in held))
                held = ([], [])
        holders.update(set(links))
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        found.append((doc, len(a), len(b), len(groups), links, sha))
    best = Counter()
    for (x, _), n in holders.items():
        best[x] = max(best[x], n)
    return sorted(
        ((d, na, nb, ng, len(links), sum(holders[p] == best[p[0]] for p in links), sum(holders[p] for p in links), sha) for d, na, nb, ng, links, sha in found),
        key=repr,
    )


ODD_TEXTS = [
    "a  b   c\t\td\n\ne ", " lead", "  two", "tail ", "tail  ", " ", "   ", "\n", "\n\n x", "a\r\nb", "can't we'll I'M", "<|endoftext|> and <s> </s> <0x41> <unk>",
    "mark\u2581inside", "wide\u3000space \u00a0 and \x85", "日本語 テキスト 🙂🙂 e\u0301 ﬁ", "\x00 nul \x1f", "12345 67.89 #$%", "ñandú Straße ÀÉ", "x" * 300, "word\nword\n\nword",
]


def test_alignment_against_loops(make, odd_rows):
    rows = [*odd_rows, *((100 + k, t) for k, t in enumerate(ODD_TEXTS)), *((200 + k, t) for k, t in enumerate(ODD_TEXTS[:5]))]
    found = sorted((tuple(r) for r in align.align(make(rows), A_PATH, B_PATH).collect()), key=repr)
    want = brute_alignment(rows)
    assert found == want
    assert any(r[1] == 0 for r in found if r[0] == 112) and sum(r[1] > 0 for r in found) > 20


def test_alignment_many_chunks_and_buckets(spark, make, monkeypatch):
    monkeypatch.setattr(align, "BUCKET_PAIRS", 50)
    monkeypatch.setattr(align, "CHUNK_BYTES", 400)
    monkeypatch.setattr(align, "BATCH_BYTES", 150)
    rng = random.Random(3)
    rows = [(k, " ".join(rng.choice(["the", "straße", "ab c", "Ünder", f"w{rng.randrange(40)}", "hot"]) for _ in range(rng.randrange(30)))) for k in range(80)]
    rows += [(k, "hot hot copy") for k in range(40)]
    found = sorted((tuple(r) for r in align.align(make(rows), A_PATH, B_PATH).collect()), key=repr)
    assert found == brute_alignment(rows)


def test_alignment_empty_table(make):
    assert align.align(make([(1, "x")]).limit(0), A_PATH, B_PATH).count() == 0
    assert [tuple(r)[1:] for r in align.align(make([(1, None)]), A_PATH, B_PATH).collect()] == [(0, 0, 0, 0, 0, 0, "")]


def test_words_are_cut_only_where_both_sides_allow():
    """Joining the ids of the cut words gives the ids of the whole text, on both sides."""
    import pyarrow as pa

    side_a, side_b = align.sides(A_PATH, B_PATH)
    assert side_a.coder is not None and side_b.cuts
    rng = random.Random(1)
    for _ in range(300):
        text = " " + "".join(rng.choice([" ", " ", "\n", "\t", "a", "Bc", "é", "1", "'s", "-", "\u00a0", "🙂", "the"]) for _ in range(rng.randrange(1, 30)))
        block = align.pieces_of(*W.plain(pa.array([text])), side_b.cuts)
        words = [w.decode() for w in block.texts(np.arange(len(block)))]
        assert "".join(words) == text
        assert sum(side_a.encode(words), []) == side_a.coder.encode_ordinary(text)
        if text != " ":
            assert sum(side_b.encode(words), []) == side_b.model.encode(text[1:]), text
