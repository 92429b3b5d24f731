"""The training-data operators against brute force, and on odd input."""

from __future__ import annotations

import html
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from metricspark.llm import decontam, html_text, langid, license_scan, mixing, near_dup, quality, sharding, token_counts, token_files, tokens
from metricspark.llm.graph import connected_components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, sid string, slots string, rank int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def odd_rows() -> list[tuple]:
    """Nulls everywhere, empty and long texts, repeated rows, repeated and null ids, clashing columns."""
    prose = "The cat sat on the mat and looked at the other cat for a long while before it left. " * 6
    rows = [
        (1, prose, "en", "a", 1),
        (1, prose, "en", "a", 1),
        (2, prose + "extra words at the end", "en", None, None),
        (3, None, None, "b", 0),
        (4, "", "en", "b", 0),
        (5, " \t\n ", None, None, 3),
        (None, prose, "en", "a", 1),
        (None, None, None, None, None),
        (6, "word " * 60_000, "en", "c", 300_000),
        (7, "x" * 200_000, None, "c", 200_000),
        (8, "Le chat dort, le chien mange et la souris danse é à ü. " * 5, "fr", "b", 10),
        (9, "MIT license gnu general public license\nGNU General Public License", "en", "ünï", 10),
        (9, "another text for the same id", "en", "z", 2),
    ]
    return [(*r, "s", "t", "u", 7) for r in rows]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


# --- mixing -----------------------------------------------------------------------------------------------------------


def brute_targets(sizes, weights):
    total, target, fixed = 1.5 * sum(sizes), [0.0] * len(sizes), set()
    while len(fixed) < len(sizes):
        left = total - sum(2 * sizes[i] for i in fixed)
        w = sum(weights[i] for i in range(len(sizes)) if i not in fixed)
        target = [2.0 * s if i in fixed else left * weights[i] / w for i, s in enumerate(sizes)]
        over = {i for i, s in enumerate(sizes) if i not in fixed and target[i] > 2 * s}
        if not over:
            break
        fixed |= over
    return target


def test_mix_targets_and_caps(docs, texts):
    rows = mixing.taken_words(mixing.mix_sources(docs)).toPandas()
    assert len(rows) == len(texts)
    assert all(len(WORD.findall(texts[d])) == n for d, n in zip(rows.doc_id, rows["size"], strict=True))
    assert (rows.taken <= 2 * rows["size"]).all()
    per = rows.groupby("source").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum")).sort_index()
    want = brute_targets(list(per["size"]), [(3, 1, 2)[i % 3] for i in range(len(per))])
    assert np.allclose(per.target, want)
    assert (abs(per.taken - per.target) <= 0.05 * per.target + 64).all()
    again = mixing.taken_words(mixing.mix_sources(docs.repartition(5))).toPandas()
    assert rows.sort_values("doc_id").taken.tolist() == again.sort_values("doc_id").taken.tolist()


def test_fill_targets_cases():
    for sizes in ([5, 0, 100, 3], [1], [0, 0], [10, 10, 10, 10, 1000]):
        weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
        got = mixing.fill_targets(sizes, weights, 1.5 * sum(sizes), 2)
        assert np.allclose(got, brute_targets(sizes, weights)) and math.isclose(sum(got), 1.5 * sum(sizes), abs_tol=1e-9)


def test_permutations():
    for n in (1, 2, 3, 17, 1000):
        assert sorted(mixing.permute(np.arange(n), n, 5)) == list(range(n))


def test_draws_are_multinomial_and_settled_to_the_quotas():
    quota, capacity = np.array([1000, 0, 370, 630]), 16
    counts = np.array([mixing.draw_shard(quota, capacity, k, 3) for k in range(125)])
    assert (counts.sum(axis=1) == capacity).all() and (counts[:, 1] == 0).all()
    # dispersion of independent draws, which draws without replacement would fall short of
    expected = capacity * quota / quota.sum()
    chi = ((counts - expected) ** 2 / np.maximum(expected, 1e-9))[:, quota > 0].sum()
    assert 250 - 5 * math.sqrt(500) < chi < 250 + 5 * math.sqrt(500)
    drawn = counts.sum(axis=0)
    assert (drawn != quota).any()
    slots = [mixing.settle(s, np.arange(drawn[s]), quota, drawn) for s in range(4)]
    source, number = (np.concatenate(c) for c in zip(*slots, strict=True))
    for s in range(4):
        assert sorted(number[source == s]) == list(range(quota[s]))


def test_slots_and_blocks_join_by_index(docs, texts):
    """The mix against its definition: every slot once, blocks by passes, and words counted by hand."""
    mix = mixing.mix_sources(docs, block_words=32, shard_slots=64)
    slots = mix.slots.toPandas()
    assert len(slots) == sum(c.slots for c in mix.mixture)
    for _, shard in slots.groupby("shard"):
        assert sorted(shard.slot) == list(range(len(shard)))
    for c in mix.mixture:
        drawn = Counter(slots.block[slots.sid == c.sid])
        passes, rest = divmod(c.slots, c.blocks)
        assert Counter(drawn.get(b, 0) for b in range(c.blocks)) == Counter({passes: c.blocks - rest, passes + 1: rest}) - Counter({passes: 0, passes + 1: 0})
    stream: dict[int, list] = {}
    for r in sorted(mix.documents.collect(), key=lambda r: (r.sid, r.start)):
        words = stream.setdefault(r.sid, [])
        assert len(words) == r.start
        words += [r.doc_id] * len(WORD.findall(texts[r.doc_id]))
    want = Counter()
    for s, b in zip(slots.sid, slots.block, strict=True):
        want.update(stream[s][b * 32 : b * 32 + 32])
    got = {r.doc_id: r.taken for r in mixing.taken_words(mix).collect()}
    assert {d: n for d, n in got.items() if n} == dict(want)
    spans = mix.spans.groupBy("shard", "slot").agg(F.sum("n_words").alias("n")).toPandas()
    assert (spans.n <= 32).all() and len(spans) == len(slots)


def test_mixed_documents_are_whole(spark):
    rows = [(1, "a  b\nc d\te", "s", 0), (2, "f g h", "s", 0), (2, "f g h", "s", 0), (None, "i j", None, 1), (None, "k", None, 1), (3, "", "s", 0), (4, None, "t", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copies long")
    out = mixing.mixed_documents(df, block_words=3)
    assert out.columns == df.columns
    taken, given = Counter(map(tuple, out.collect())), Counter(rows)
    assert taken and all(r in given and n <= 2 * given[r] and r[1] for r, n in taken.items())
    assert mixing.mixed_documents(df.limit(0)).count() == 0


def test_a_long_text_is_not_copied_block_by_block(spark):
    df = spark.createDataFrame([(1, "word " * 1_000_000, "s"), (2, "a few words", "s")], "doc_id long, text string, source string")
    assert mixing.mixed_documents(df).agg(F.max(F.length("text"))).first()[0] == 5_000_000
    rows = {r.doc_id: r for r in mixing.taken_words(mixing.mix_sources(df)).collect()}
    assert abs(rows[1].taken + rows[2].taken - 1.5 * 1_000_003) <= 64


def test_repeated_rows_and_partitions_do_not_change_the_mix(spark):
    rows = [(7, "same words here again", "s")] * 300 + [(None, f"null id text {i}", "s") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    one, two = (Counter((r.doc_id, r.taken) for r in mixing.taken_words(mixing.mix_sources(d)).collect()) for d in (df.repartition(2), df.repartition(7)))
    assert one == two and sum(one.values()) == 600


def test_too_many_sources_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_SOURCES", 2)
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "z")], "doc_id long, text string, source string")
    with pytest.raises(ValueError, match="sources"):
        mixing.mix_sources(df)


def test_mix_odd_input(odd, empty):
    rows = mixing.taken_words(mixing.mix_sources(odd)).collect()
    assert len(rows) == 13 and all(r.taken <= 2 * r.size for r in rows)
    assert all(r.taken == 0 for r in rows if r.size == 0)
    assert mixing.taken_words(mixing.mix_sources(empty)).count() == 0
    assert set(mixing.mixed_documents(odd).columns) == set(odd.columns)


# --- HTML ---------------------------------------------------------------------------------------------------------------


def brute_article(page: str) -> str:
    inside = re.search(r"<article>(.*?)(</article>|<footer>|\Z)", page, re.S)
    if not inside:
        return ""
    parts = re.split(r"</?(?:p|h1)>", re.sub(r"<[^>]*\Z", "", inside[1]))
    out = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in parts]
    return "\n".join(x for x in out if x)


def test_pages_against_their_articles(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    want = {r.page_id: brute_article(r.html) for r in pages.collect()}
    rows = html_text.main_text(pages).collect()
    assert {r.page_id: r.text for r in rows} == want
    assert all(r.n_chars == len(r.text) for r in rows)


PROSE = "A paragraph of the article, with commas, and long enough to look like prose. It goes on for a second sentence, as articles do."
MENU = "<ul>" + "".join(f"<li><a href=/{i}>Menu entry {i}</a></li>" for i in range(6)) + "</ul>"


@pytest.mark.parametrize(
    ("page", "want"),
    [
        # what a page declares
        ("<body><nav><a>m</a></nav><div id=sidebar>side, text.</div><div class=content><h1>T &amp; x</h1><p>One two, three. <br>four&nbsp;five</p><ul><li>a</li><li>b</ul><div class=comments><p>bad, yes.</p></div><form>f</form></div><footer>c</footer>", "T & x\nOne two, three. four five\na\nb"),
        ("<article><p>x</p><div class='ad'>no</div><aside>no</aside><table><tr><td>c1<td>c2<tr><td>c3</table></article><section class=comments><p>hey, no.</p></section>", "x\nc1\nc2\nc3"),
        ("<article><p>kept</p><script>var a='</p>';</script><style>p{}</style><!-- <p>no</p> --><p>and &#233;&lt;", "kept\nand é<"),
        ("<div class='cookie-notice'><p>We use cookies, many of them, all the time.</p></div><p>Short.</p>", "Short."),
        ("<article><p hidden>no</p><p>yes <span style='display:none'>no<span>no</span></span>still</p>", "yes still"),
        # names that only look like boilerplate
        (f'<div id="page" class="site has-sidebar"><article><p>{PROSE}</p></article></div>', PROSE),
        (f'<div class="content no-sidebar"><article><p>{PROSE}</p></article></div>', PROSE),
        (f'<article class="post comments-open"><p>{PROSE}</p></article>', PROSE),
        (f'<div class="search-engine-guide"><p>{PROSE}</p></div>', PROSE),
        (f'<article><p>{PROSE}</p><div class="notice-board"><p>On the board.</p></div></article>', f"{PROSE}\nOn the board."),
        (f"<article><header><h1>Title</h1></header><p>{PROSE}</p></article>", f"Title\n{PROSE}"),
        (f'<article class=post><header class=entry-header><h1>Title</h1><div class=entry-meta>By Ann</div></header><div class=entry-content><p>{PROSE}</p></div><footer>x</footer></article>', f"Title\nBy Ann\n{PROSE}"),
        # names weigh, they do not drop: a page that stands in one keeps its text
        (f"<form id=aspnet><div class=menu>{MENU}</div><div><h2>Head</h2><p>{PROSE}</p></div></form>", f"Head\n{PROSE}"),
        (f'<div class="sidebar"><p>{PROSE}</p><p>{PROSE}</p></div>', f"{PROSE}\n{PROSE}"),
        ("<nav><a>x</a></nav><div class=ad>One, two. Three.</div><footer>c, d.</footer>", ""),
        # nothing declared: the ratios alone decide
        (f"<div>{MENU}</div><div><h1>Head</h1><p>{PROSE}</p><p>{PROSE}</p><ul><li>one</li><li>two</li></ul></div><div><p>Legal, 2020.</p></div>", f"Head\n{PROSE}\n{PROSE}\none\ntwo"),
        (f"<div><div>{MENU}</div><div><div>{PROSE}</div><div>{PROSE}</div></div><div>{MENU}</div></div>", f"{PROSE}\n{PROSE}"),
        (f"<table><tr><td>{MENU}<td><p>{PROSE}<p>{PROSE}<td>Ad text</table>", f"{PROSE}\n{PROSE}"),
        (f"<div class=a1>{MENU}</div><div class=a2><div class=a3><p>{PROSE}</p></div><div class=a3><p>{PROSE}</p></div></div><div class=a4><p>Short one.</p></div>", f"{PROSE}\n{PROSE}"),
        (f"<p>{PROSE}</p><p>{PROSE}</p><blockquote>Quote.</blockquote><pre>code</pre>", f"{PROSE}\n{PROSE}\nQuote.\ncode"),
        (f"<div><p>{PROSE}</p><table><tr><th>a<th>b<tr><td>1<td>2</table><dl><dt>t<dd>d</dl></div>{MENU}", f"{PROSE}\na\nb\n1\n2\nt\nd"),
        (f"<div><h2>Section</h2><p>{PROSE}</p><h2>Next</h2><p>{PROSE}</p></div><div><h2>Links</h2>{MENU}</div>", f"Section\n{PROSE}\nNext\n{PROSE}"),
        (f"<div><section><p>{PROSE}</p></section><section><p>{PROSE}</p><p>Yes.</p></section></div>{MENU}", f"{PROSE}\n{PROSE}\nYes."),
        (f"<div><p>{PROSE}</p><figure><figcaption>Caption</figcaption></figure><div><a href=1>Prev</a> <a href=2>Next</a></div></div>", f"{PROSE}\nCaption"),
        (f"<div><a href=/>Home</a> <a href=/n>News</a></div><div><p>{PROSE} <a href=x>A link</a> in it.</p></div>", f"{PROSE} A link in it."),
        # shapes
        ("plain text only", "plain text only"),
        ("<p>a<p>b < c <b>d", "a\nb < c d"),
        ("<article><p>cut off <a hre", "cut off"),
        ("", ""),
        ("<<>>&&;", "<<>>&&;"),
    ],
)
def test_html_cases(spark, page, want):
    df = spark.createDataFrame([(1, "u", page, 5)], "page_id int, url string, html string, seq int")
    assert html_text.main_text(df).first().text == want


def test_html_ratios_against_a_plain_computation():
    page = f"<div>{MENU}</div><div><p>{PROSE}</p><p>No, yes.</p></div><div class=x>Some, text.</div>"
    found = html_text.blocks_of(page)
    texts = [f"Menu entry {i}" for i in range(6)] + [PROSE, "No, yes.", "Some, text."]
    assert found.text == texts
    ratio = lambda t: sum(map(len, t)) / len(t) * (1 + sum(len(re.findall("[.,]", x)) for x in t) / len(t))
    prose = ratio([PROSE, "No, yes."])  # the path and the box that hold most
    share = math.sqrt(len("Some, text.") / (len(PROSE) + len("No, yes.")))
    alone = ratio(["Some, text."]) * (1 + share) / 2
    around = alone * share  # the body speaks by the one path in it
    want = [*[0.3 * around / 4] * 6, *[prose / 2 + prose / 4 + around / 4] * 2, alone / 2 + around / 4]
    assert np.allclose(html_text.scores(found), want)


def test_html_pages_without_their_declarations(spark, sf_dir):
    """The given pages with ``article``, ``nav``, ``footer`` and ad classes taken away: few lose or gain a block."""
    right = total = 0
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        want = brute_article(r.html)
        bare = re.sub(r"<(/?)(?:article|nav|footer)>", r"<\1div>", r.html).replace('class="ad"', "")
        if want.count("\n") >= 8:
            total += 1
            right += html_text.extract(bare) == want
    assert total >= 5 and right >= 0.9 * total


@pytest.mark.parametrize(
    "page",
    ["<div>" * 100_000 + "x", "<i>" * 8_000 + "</b>" * 8_000, "<li><ul>" + "<div>" * 8_000 + "<li></li>" * 8_000, "<span hidden>" * 8_000, "<div class='a b'><p>t.</p>" * 20_000, '<a "' * 50_000],
)
def test_html_time_is_linear(page):
    import time

    began = time.perf_counter()
    html_text.extract(page)
    assert time.perf_counter() - began < 5


def test_html_odd_input(spark):
    df = spark.createDataFrame([(1, None, None), (1, None, None), (None, "u", "<p>x" * 20_000), (2, "u", "<" * 50_000)], "page_id int, url string, html string")
    rows = html_text.main_text(df).collect()
    assert len(rows) == 4 and sorted(r.n_chars for r in rows)[:2] == [0, 0]
    assert html_text.main_text(df.limit(0)).count() == 0


# --- token files and counts -------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    pytest.importorskip("tokenizers")
    return tokens.public_tokenizer("word_bpe_49k.json")


@pytest.fixture(scope="module")
def reference(tokenizer):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer)
    return lambda s: t.encode(s, add_special_tokens=False).ids


TRICKY = ["it's a'b don't 'S WE'LL\x1ca\x1db <|endoftext|> x<|startoftext|>y", " a b é é ́x 日本 123 ½ Ⅷ ǅ İ ſ", "a\x00b\x7f", "ÅNGSTRÖM ﬁ ’s ’S", "", "   ", "<|", "12'3 ...!? A1b2"]


def test_encoder_equals_the_library(tokenizer, reference, texts):
    small = tokens.Encoder(tokenizer, entries=50)  # generations turn over
    for text in [*TRICKY, *texts.values()]:
        assert np.frombuffer(small.encode(text.encode()), small.dtype).tolist() == reference(text)


def test_encoder_forgets_by_bytes(tokenizer):
    """Long chunks, each met once, fill the cache with bytes before they fill it with entries."""
    coder = tokens.Encoder(tokenizer)
    for k in range(30):
        coder.encode(" ".join(f"{k}x{j}" + "ä" * 4500 for j in range(100)).encode())
    kept = [x for cache in (coder._chunks, coder._runs) for half in (cache.new, cache.old) for item in half.items() for x in item]
    assert sum(map(len, kept)) < 1 << 25


def test_encoder_cuts_long_texts_at_white_space(tokenizer, reference, monkeypatch):
    monkeypatch.setattr(tokens, "PIECE", 7)
    coder = tokens.Encoder(tokenizer)
    for text in [*TRICKY, "a" * 30 + " b\x0b" + "c d\t" * 9, "x" * 20, " " * 20]:
        assert np.frombuffer(coder.encode(text.encode()), coder.dtype).tolist() == reference(text)


def test_encoder_property(tokenizer, reference):
    hypothesis = pytest.importorskip("hypothesis")
    coder = tokens.Encoder(tokenizer)

    @hypothesis.settings(max_examples=300, deadline=None)
    @hypothesis.given(hypothesis.strategies.text(hypothesis.strategies.characters(codec="utf-8"), max_size=40))
    def check(text):
        assert np.frombuffer(coder.encode(text.encode()), coder.dtype).tolist() == reference(text)

    check()


def test_token_files_round_trip(docs, texts, tokenizer, reference, spark):
    written = token_files.write_token_files(docs, tokenizer, shards=3)
    rows = sorted(token_files.read_digests(written).collect(), key=lambda r: r.doc_id)
    at = 0
    for row, (doc, text) in zip(rows, sorted(texts.items()), strict=True):
        ids = [*reference(text), 2]
        assert (row.doc_id, row.start, row.n_tokens) == (doc, at, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        at += len(ids)
    wanted = spark.createDataFrame([(5,), (17,), (10**9,)], "doc_id long")
    found = {r.key: list(r.ids) for r in token_files.lookup(written, wanted).collect()}
    assert found == {k: [*reference(texts[k]), 2] for k in (5, 17)}


def test_perfect_hash_is_minimal_and_rejects_strangers():
    keys = np.random.default_rng(1).integers(-(2**60), 2**60, 20_000)
    keys = np.unique(keys)
    hashed = token_files.PerfectHash.build(keys)
    assert sorted(hashed.slots(keys)) == list(range(len(keys)))
    assert len(token_files.PerfectHash.build(keys[:0]).slots(keys[:3])) == 3
    strangers = keys[:5000] + 1
    slot = hashed.slots(strangers)
    prints = np.empty(len(keys), dtype=np.uint32)
    prints[hashed.slots(keys)] = token_files.fingerprints(keys)
    known = slot >= 0
    assert (prints[slot[known]] == token_files.fingerprints(strangers[known])).sum() <= len(np.intersect1d(strangers, keys)) + 1


def test_other_tokenizers_go_through_the_library(spark):
    from tokenizers import Tokenizer

    path = tokens.public_tokenizer("byte_bpe_50k.json")
    coder, library = tokens.Encoder(path), Tokenizer.from_file(path)
    for text in [*TRICKY, "  two  spaces", "tab\tand\nline"]:
        assert np.frombuffer(coder.encode(text.encode()), coder.dtype).tolist() == library.encode(text, add_special_tokens=False).ids


def test_lookup_of_null_repeated_and_unknown_keys(spark, tokenizer, reference):
    rows = [(None, "no key"), (1, "one"), (1, "one again"), (1, "one more"), (2, None)] + [(k, f"text {k}") for k in range(10, 300)]
    written = token_files.write_token_files(spark.createDataFrame(rows, "doc_id long, text string"), tokenizer, shards=5)
    wanted = spark.createDataFrame([(1,), (1,), (2,), (None,), (9,), (299,), (-5,)], "doc_id long")
    got = Counter((r.key, tuple(r.ids)) for r in token_files.lookup(written, wanted).collect())
    want = Counter((k, (*reference(t or ""), 2)) for k, t in rows if k in (1, 2, 299))
    assert got == want


def test_suffix_sums_are_linear(spark):
    n = 200_000
    sums = token_counts.with_suffix_sums(spark.range(1, n + 1).select(F.col("id").alias("n_tokens"), F.lit(1).cast("long").alias("n_docs")))
    import time

    began = time.perf_counter()
    row = sums.agg(F.max("tokens_from").alias("m"), F.sum("docs_from").alias("s")).first()
    assert (row.m, row.s) == (n * (n + 1) // 2, n * (n + 1) // 2) and time.perf_counter() - began < 20


def test_token_files_odd_input(odd, empty, tokenizer):
    rows = token_files.read_digests(token_files.write_token_files(odd, tokenizer, shards=2)).collect()
    assert len(rows) == 13 and sum(r.doc_id is None for r in rows) == 2
    assert sorted(r.start for r in rows)[0] == 0
    assert token_files.read_digests(token_files.write_token_files(empty, tokenizer, shards=2)).count() == 0


def test_length_histogram(docs, texts, tokenizer, reference, odd, empty):
    sums = token_counts.with_suffix_sums(token_counts.length_histogram(docs, tokenizer))
    lengths = sorted(len(reference(t)) for t in texts.values())
    for r in sums.collect():
        assert r.n_docs == lengths.count(r.n_tokens)
        assert r.docs_from == sum(n >= r.n_tokens for n in lengths) and r.tokens_from == sum(n for n in lengths if n >= r.n_tokens)
        assert r.truncated_total == sum(min(n, r.n_tokens) for n in lengths)
    for r in token_counts.truncated_totals(sums, [1, 128, 10**7]).collect():
        assert r.kept_tokens == sum(min(n, r.context_limit) for n in lengths) and r.n_cut == sum(n > r.context_limit for n in lengths)
    middle = token_counts.quantiles(sums, [0.5]).first().n_tokens
    assert middle == lengths[math.ceil(0.5 * len(lengths)) - 1]
    assert token_counts.length_histogram(odd, tokenizer).agg(F.sum("n_docs")).first()[0] == 13
    assert token_counts.with_suffix_sums(token_counts.length_histogram(empty, tokenizer)).count() == 0


# --- decontamination ------------------------------------------------------------------------------------------------------------


def test_benchmark_passages_are_found(spark, sf_dir, docs, texts):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = {r.item_id: r.text for r in benchmark.collect()}
    want = {d for d, t in texts.items() if any(i in t for i in items.values())}
    hits = decontam.contaminated(docs, benchmark)
    got = {r.doc_id for r in decontam.contaminated_documents(hits).collect()}
    assert got == want
    kept = {r.doc_id for r in decontam.decontaminate(docs, benchmark).collect()}
    assert kept == set(texts) - want


def test_changed_values_are_caught_and_inconsistent_ones_are_not(spark):
    ask = "If {} has {} apples and buys {} more apples for {} {} each, how many does {} have?"
    rows = [
        (1, "Intro. " + ask.format("Tom Hill", 5, 7, 3, "dollars", "Tom Hill")),
        (2, ask.format("Mary Poe", 15, 27, 13, "euros", "Mary Poe") + " Thanks."),
        (3, ask.format("Mary Poe", 15, 27, 13, "euros", "John")),
        (4, "Nothing of the kind stands here, only some apples and how many of them there are."),
        (5, None),
        (6, ""),
        (None, ask.format("Sue", 2, 4, 6, "dollars", "Sue")),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, ask.format("Sue", 2, 4, 6, "dollars", "Sue")), (2, None), (3, "")], "item_id long, text string")
    hits = {r.doc_id: r for r in decontam.contaminated(docs, bench).collect()}
    assert set(hits) == {1, 2, None} and hits[1].changed and hits[2].changed and not hits[None].changed
    assert {r.doc_id for r in decontam.decontaminate(docs, bench).collect()} == {3, 4, 5, 6}
    assert decontam.contaminated(docs, bench.limit(0)).count() == 0
    assert decontam.contaminated(docs.limit(0), bench).count() == 0


@pytest.mark.parametrize("bits", [1, 16])
def test_the_filter_only_saves_work(spark, sf_dir, docs, monkeypatch, bits):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    monkeypatch.setattr(decontam, "FILTER_BITS", bits)
    monkeypatch.setattr(decontam, "MOST_FILTER_BITS", 16)
    hits = {r.doc_id for r in decontam.contaminated(docs, benchmark).collect()}
    items = [r.text for r in benchmark.collect()]
    assert hits == {r.doc_id for r in docs.collect() if any(i in r.text for i in items)}


def test_lost_hits_are_found(spark):
    ask = "If {0} has {1} apples and buys {2} more apples for {3} {4} each, how many does {0} have?"
    short, sums = "Name the capital of France.", "What is 12 + 7 * 3 - 4 / 2 ?"
    opened = "{} has 5 red apples and eats some of them at lunch"
    bench = [(1, ask.format("Sue", 5, 7, 6, "dollars")), (None, sums), (3, short), (3, opened.format("Tom")), (4, "yes"), (5, ask.format("Bob", 3, 9, 2, "euros"))]
    rows = [
        (1, ask.format("Ann", 4, 4, 9, "pounds"), True),  # two values of the item are one here
        (2, sums, True),
        (3, f"He asked: {sums} Nobody knew.", True),
        (4, "What is 12 + 7 * 3 - 4 / 3 ?", False),
        (5, f"please {short.lower()} and more text", True),
        (6, opened.format("Mary") + " with others.", True),
        (7, "Yes.", True),
        (8, "Yes, it is.", False),
        (9, ask.format("Ann", 4, 4, 9, "pounds") + " text", True),
        (9, "A clean text under the same id, of some length and without any question in it.", False),
        (9, "Another. " + ask.format("Eve", 1, 2, 3, "dollars"), True),
        (None, ask.format("Eve", 1, 2, 3, "dollars"), True),
        (None, "A clean text without an id.", False),
        (None, None, False),
        (10, "word " * 30_000 + ask.format("Eve", 1, 2, 3, "dollars") + " word" * 30_000, True),
        (10, "word " * 30_000 + ask.format("Eve", 1, 2, 3, "dollars") + " word" * 30_000, True),
    ]
    docs = spark.createDataFrame([(d, t, i, i, i) for i, (d, t, _) in enumerate(rows)], "doc_id long, text string, row_1 int, key int, slots int")
    hits = decontam.contaminated(docs, spark.createDataFrame(bench, "item_id long, text string"))
    kept = {r.row_1 for r in decontam.decontaminate(docs, spark.createDataFrame(bench, "item_id long, text string")).collect()}
    assert kept == {i for i, (_, _, leak) in enumerate(rows) if not leak}
    by = Counter(r.doc_id for r in decontam.contaminated_documents(hits).collect())
    assert by == Counter({1: 1, 2: 1, 3: 1, 5: 1, 6: 1, 7: 1, 9: 2, None: 1, 10: 1})  # equal rows count once


def brute_template(text):
    """Template tokens with their values by regular expressions; opening names are marked."""
    out = []
    for m in re.finditer(r"\d+(?:[.,]\d+)*|[A-Za-z\x80-\U0010ffff]+(?:'[A-Za-z\x80-\U0010ffff]+)*|[$%]+", text):
        word, low = m[0], m[0].lower()
        before = text[: m.start()]
        last = re.search(r"[A-Za-z0-9$%\x80-\U0010ffff]", before[::-1])
        opens = last is None or bool(re.search(r"[.!?\n:;\"]", before[len(before) - last.start() :] if last.start() else ""))
        kind = "<n>" if word[0].isdigit() else "<u>" if word[0] in "$%" or low in decontam.UNITS else "<p>" if word[0].isupper() else low
        if kind == "<p>" and out and out[-1][0] == "<p>" and not out[-1][2] and out[-1][4] == m.start() - 1 and text[m.start() - 1] == " ":
            out[-1] = ("<p>", low, out[-1][2], out[-1][3], m.end())
        else:
            out.append((kind, low, opens and kind == "<p>", m.start(), m.end()))
    return out


def brute_hits(doc, items, n=8):
    """Numbers of the items whose windows a text holds consistently, by comparing all windows."""
    tokens, found = brute_template(doc), set()
    for number, item in enumerate(items):
        own = brute_template(item)
        usable = [i for i in range(len(own) - n + 1) if sum(t[0][0] != "<" for t in own[i : i + n]) >= 4]
        if 2 * len(usable) < len(own) - n + 1 or not usable:
            continue
        checked = {t[1] for t in own if t[0][0] == "<" and not t[2]}
        for shift in range(-len(own), len(tokens)):
            at = [i for i in usable if 0 <= i + shift <= len(tokens) - n and [t[0] for t in own[i : i + n]] == [t[0] for t in tokens[i + shift : i + shift + n]]]
            bound: dict[str, set] = {}
            for i in at:
                for a, b in zip(own[i : i + n], tokens[i + shift : i + shift + n], strict=True):
                    if a[0][0] == "<" and a[1] in checked:
                        bound.setdefault(a[1], set()).add(b[1])
            if (100 * len(at) >= 50 * len(usable) or len(at) >= 6) and all(len(v) == 1 for v in bound.values()):
                found.add(number)
    return found


def test_templates_and_slots_against_brute_force(spark, sf_dir, docs, texts):
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    ask = "If {0} has {1} apples and {2} buys {3} more apples for {4} dollars, how many does {0} have?"
    items = [*items[:6], ask.format("Sue", 3, "Bob", 4, 5)]
    rng = np.random.default_rng(8)
    made = {10_000 + i: f"Text {i}. " + ask.format(*rng.choice(["Ann", "Eve", "Joe Hill"], 1), *rng.integers(1, 9, 1), *rng.choice(["Al", "Zoe"], 1), *rng.integers(1, 9, 2)) for i in range(6)}
    made |= {20_000: ask.format("Ann", 1, "Al", 2, 3).replace("does Ann", "does Eve"), 20_001: items[0][:60], 20_002: items[1] + " " + items[2].upper()}
    some = {d: t for d, t in texts.items() if d < 60 or any(i in t for i in items)} | made
    df = spark.createDataFrame(list(some.items()), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got: dict[int, set] = {}
    for r in decontam.contaminated(df, bench).collect():
        got.setdefault(r.doc_id, set()).add(r.item_id)
    assert got == {d: h for d, t in some.items() if (h := brute_hits(t, items))}


def test_templates():
    t = decontam.canonical("John Smith has 1,234.5 km. He paid $4 for 2 kg of Red Plums, didn't he?".encode())
    names = {1: "<n>", 2: "<u>", 3: "<p>"}
    got = [names.get(int(x), t.value(i)) for i, x in enumerate(t.tokens)]
    assert got == ["<p>", "<p>", "has", "<n>", "<u>", "<p>", "paid", "<u>", "<n>", "for", "<n>", "<u>", "of", "<p>", "didn't", "he"]
    assert [t.value(i) for i in np.flatnonzero(t.opens)] == ["john", "he"]


# --- near duplicates ------------------------------------------------------------------------------------------------------------------


def brute_components(texts: dict) -> dict:
    def shingles(t):
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())

    sets = {d: shingles(t) for d, t in texts.items()}
    label = {d: d for d in texts}
    ids = sorted(texts)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    moved = True
    while moved:
        moved = False
        for a, b in links:
            low = min(label[a], label[b])
            moved |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return {d: (len(sets[d]), label[d]) for d in texts}


def check_near(df, texts):
    want = brute_components(texts)
    for r in near_dup.near_duplicates(df).collect():
        assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)


def test_near_duplicates_against_brute_force(docs, texts):
    check_near(docs, texts)


def test_near_duplicate_chains_need_the_second_sweep(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(120)]
    texts = {}
    for k in range(60):  # variants of one text that are near it but not always near each other
        copy = list(words)
        for at in rng.choice(120, 4, replace=False):
            copy[at] = f"v{k}_{at}"
        texts[k] = " ".join(copy)
    texts |= {100 + i: t for i, t in enumerate(["Same Words", "same words", "same", "", "a b c d e", "a b c d e f"])}
    check_near(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), texts)


def test_one_large_bucket_is_tiled(spark, monkeypatch):
    """A family in which most members share every bucket and few are near the smallest one."""
    monkeypatch.setattr(near_dup, "TILE", 8)
    rng = np.random.default_rng(9)
    words, texts = [f"w{i}" for i in range(150)], {}
    for k in range(90):
        copy = list(words)
        for at in rng.choice(150, 5, replace=False):
            copy[at] = f"v{k % 30}_{at}"
        texts[k] = " ".join(copy)
    check_near(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), texts)


def test_twenty_thousand_members_of_one_bucket(spark):
    base = " ".join(f"w{i}" for i in range(60))
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit(base + " "), F.col("id").cast("string")).alias("text"))
    rows = near_dup.near_duplicates(df).groupBy("component_id").count().collect()
    assert [(r.component_id, r["count"]) for r in rows] == [(0, 20_000)]


def test_near_duplicates_odd_input(odd, empty, spark):
    rows = near_dup.near_duplicates(odd).collect()
    assert len(rows) == 13
    by = {(r.doc_id, r.n_shingles): r for r in rows}
    assert by[(3, 0)].component_id == 3 and by[(3, 0)].kept and by[(5, 0)].component_id == 5
    assert all(r.component_id is None and r.kept for r in rows if r.doc_id is None)
    assert {r.component_id for r in rows if r.doc_id in (1, 2)} == {1}
    assert near_dup.near_duplicates(empty).count() == 0
    kept = near_dup.deduplicate(odd.drop("rank")).collect()
    assert sum(r.doc_id == 1 for r in kept) == 1 and not any(r.doc_id == 2 for r in kept)


def test_sketch_estimates():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64)
    for overlap, passes in ((400, True), (360, True), (100, False)):
        other = np.concatenate([base[:overlap], rng.integers(0, 2**63, 400 - overlap, dtype=np.uint64)])
        a, b = (near_dup.odd_sketch(near_dup.minhash(np.unique(x))) for x in (base, other))
        bits = int(np.bitwise_count((a ^ b).view(np.uint64)).sum())
        assert (bits <= near_dup.sketch_limit(0.75)) == passes


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(200, 200), (None, 3), (300, 301), (300, 301)], "u long, v long")
    got = {r.vertex: r.component for r in connected_components(edges).collect()}
    assert all(got[i] == 0 for i in range(51)) and got[301] == 300 and got[200] == 200
    assert connected_components(edges.limit(0)).count() == 0


# --- licenses ----------------------------------------------------------------------------------------------------------------------------


def brute_license(text: str | None):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = re.findall(license_scan.WORD, (text or "").translate(fold))
    places, base = [], set()
    for phrase, label in license_scan.PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    met, best = set(), 1.0 if places else 0.0
    for t in license_scan.templates_of(license_scan.NOTICES):
        for k in range(0, max(1, len(words)), t.stride):
            common = len(set(t.words) & set(words[k : k + t.window]))
            if 100 * common >= license_scan.PERCENT * len(t.words):
                met.add(t.label)
                best = max(best, common / len(t.words))
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | met)), best


def check_licenses(df, rows):
    got = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9)) for r in license_scan.scan_licenses(df).collect())
    want = Counter((d, *(b := brute_license(t))[:-1], round(b[-1], 9)) for d, t in rows)
    assert got == want


def test_licenses_against_brute_force(docs, texts):
    check_licenses(docs, texts.items())


def test_license_cases(spark, odd, empty):
    notices = license_scan.NOTICES
    rows = [
        (1, "intro " * 100 + notices["mit"] + " tail" * 90),
        (2, " ".join(notices["mit"].split()[: len(notices["mit"].split()) // 2])),
        (3, "cc by cc-by CC BY x gnu general public licenses"),
        (4, "mité license mit license"),
        (5, None),
        (6, "This work is licensed under the GNU General Public License, version 3."),
        (7, "The album was released last spring. Under the new rules a fishing license is required"),
        (8, notices["cc-by-4.0-notice"].replace("work", "wor\u212a")),
        (9, "... ,, ; MIT License!"),
        (10, notices["isc"].upper() + " word" * 40_000 + notices["zlib"]),
    ]
    labels = {r.doc_id: r.labels for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert labels[1] == "mit" and labels[7] == "" and labels[10] == "isc,zlib"
    check_licenses(spark.createDataFrame(rows, "doc_id long, text string"), rows)
    check_licenses(odd, [(r[0], r[1]) for r in odd_rows()])
    assert license_scan.scan_licenses(empty).count() == 0


def test_native_plans_have_no_python(docs, monkeypatch):
    """The last plan and every plan before a staged table."""
    from metricspark.llm import staging

    seen, write = [], staging.stage

    def watched(df, name):
        seen.append(df._jdf.queryExecution().toString())
        return write(df, name)

    monkeypatch.setattr(license_scan, "stage", watched)
    monkeypatch.setattr(sharding, "stage", watched)
    for df in (license_scan.scan_licenses(docs), sharding.shard_by_bytes(docs)):
        seen.append(df._jdf.queryExecution().toString())
    assert len(seen) >= 9 and not any(re.search("Python|Pandas|Arrow", plan) for plan in seen)


# --- sharding -------------------------------------------------------------------------------------------------------------------------------


def least_capacity(sizes, parts):
    def fits(c):
        n, load = 1, 0
        for s in sizes:
            n, load = (n, load + s) if load + s <= c else (n + 1, s)
        return n <= parts

    c = max(max(sizes), -(-sum(sizes) // parts))
    while not fits(c):
        c += 1
    return c


@pytest.mark.parametrize(("seed", "parts", "count"), [(1, 1, 9), (2, 3, 40), (3, 5, 17), (4, 24, 60), (5, 24, 5)])
def test_partition_is_minimax(spark, seed, parts, count):
    sizes = np.random.default_rng(seed).integers(1, 200, count).tolist()
    rows = sharding.partition_cells(spark.createDataFrame([(i * 2, s) for i, s in enumerate(sizes)], "cell long, bytes long"), parts).collect()
    rows.sort(key=lambda r: r.cell)
    shards = [r.shard for r in rows]
    loads = Counter()
    for shard, size in zip(shards, sizes, strict=True):
        loads[shard] += size
    assert shards == sorted(shards) and max(shards) < parts
    assert max(loads.values()) == least_capacity(sizes, parts)


def check_shards(rows, pairs, shards):
    assert len(rows) == len(pairs)
    slots: dict[int, list[int]] = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and max(slots, default=0) < shards
    want = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in pairs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    place: dict[tuple, set] = {}
    for r in rows:
        place.setdefault((r.size, r.text_crc32), set()).add(r.shard)
    assert all(len(s) == 1 for s in place.values())


def test_shards(docs, texts, odd, empty):
    rows = sharding.shard_by_bytes(docs, 24).collect()
    check_shards(rows, list(texts.items()), 24)
    check_shards(sharding.shard_by_bytes(odd, 3).collect(), [(r[0], r[1]) for r in odd_rows()], 3)
    assert sharding.shard_by_bytes(empty).count() == 0
    carried = sharding.shard_by_bytes(odd, 3, carry=True).select("document.*")
    assert sorted(map(str, carried.collect())) == sorted(map(str, odd.collect()))


# --- quality ----------------------------------------------------------------------------------------------------------------------------------


def brute_quality(text: str | None):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), len(lines)


def test_quality_measures(docs, texts, odd, empty):
    for df, pairs in ((docs, list(texts.items())), (odd, [(r[0], r[1]) for r in odd_rows()])):
        rows = quality.ledger(df).collect()
        assert Counter((r.doc_id, *(r[m] for m in quality.MEASURES)) for r in rows) == Counter((d, *brute_quality(t)) for d, t in pairs)
    assert quality.apply_policy(quality.ledger(empty), 2).count() == 0


def test_quality_policies_and_ablations(docs):
    rows = quality.apply_policy(quality.ledger(docs), 2)
    bits = [(r.fail_bits, r.kept) for r in rows.collect()]
    mask = quality.POLICIES[2]
    assert all(kept == (b & mask == 0) for b, kept in bits)
    for r in quality.ablations(rows, 2).collect():
        bit = 1 << next(x.bit for x in quality.RULES if x.name == r.rule)
        assert r.n_failed == sum(b & bit != 0 for b, _ in bits)
        assert r.n_only == sum(b & mask == bit for b, _ in bits)
        assert r.n_kept_without == sum(b & mask & ~bit == 0 for b, _ in bits)
    first = quality.apply_policy(quality.ledger(docs), 1).filter("kept").count()
    assert first >= rows.filter("kept").count() > 0


# --- language ----------------------------------------------------------------------------------------------------------------------------------


def test_language_accuracy_on_held_out_rows(docs, spark):
    rows = docs.withColumn("held", F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0)
    model = langid.fit_text_model(rows.filter("not held"), "lang", "text", "doc_id")
    held = rows.filter("held")
    got = {r.doc_id: r for r in langid.identify(held, model).collect()}
    right = [got[r.doc_id].lang == r.lang for r in held.collect()]
    assert len(right) > 20 and sum(right) / len(right) > 0.95


def test_evidence_decides_where_text_is_silent(spark, docs):
    model = langid.fit_text_model(docs, "lang", "text", "doc_id")
    rows = docs.select("doc_id", "text", F.col("lang").alias("declared"), F.lit("http://www.example.org/fr/1").alias("url"))
    rows = rows.filter("declared = 'fr'").union(spark.createDataFrame([(-1, "zq xj", "fr", "http://www.example.org/fr/2"), (-2, "", "fr", None), (-3, "123 456", None, None)], "doc_id long, text string, declared string, url string"))
    got = {r.doc_id: r for r in langid.identify(rows, model, declared=F.col("declared"), suffix=langid.address_suffix(F.col("url")), host=langid.host_of(F.col("url"))).collect()}
    assert got[-1].lang == "fr" and got[-1].kept
    assert not got[-2].kept and not got[-3].kept
    assert all(r.kept for d, r in got.items() if d >= 0)


@pytest.mark.parametrize(
    ("url", "host", "suffix"),
    [("http://www.Example.co.uk:80/de/x", "www.example.co.uk", "/de"), ("https://a.fr", "a.fr", ".fr"), ("nothing", None, None), ("http://u:p@h.net/deep/en", "h.net", ".net"), (None, None, None)],
)
def test_addresses(spark, url, host, suffix):
    row = spark.createDataFrame([(url,)], "u string").select(langid.host_of(F.col("u")).alias("h"), langid.address_suffix(F.col("u")).alias("s")).first()
    assert (row.h, row.s) == (host, suffix)


def test_markup_language(spark):
    df = spark.createDataFrame([('<!DOCTYPE html><HTML class="x" lang="de-AT">',), ("<html>",), (None,)], "h string")
    assert [r[0] for r in df.select(langid.declared_in_markup(F.col("h"))).collect()] == ["de", None, None]


def brute_posteriors(scores, declared, suffix, host):
    """Fusion by hand from the text log likelihoods of each row."""
    kinds = range(len(scores[0]))
    shares = [[math.exp(x) / sum(map(math.exp, row)) for x in row] for row in scores]
    corpus = [sum(t[k] for t in shares) / len(shares) for k in kinds]

    def table(keys, strength, prior):
        return {v: [(sum(t[k] for t, x in zip(shares, keys, strict=True) if x == v) + strength * prior(v)[k]) / (keys.count(v) + strength) for k in kinds] for v in set(keys) - {None}}

    parent = [None if h is None else ".".join(h.split(".")[-2:]) for h in host]
    parents = table(parent, langid.HOST_STRENGTH, lambda v: corpus)
    hosts = table(host, langid.HOST_STRENGTH, lambda v: parents[".".join(v.split(".")[-2:])])
    said, ended = (table(x, langid.TABLE_STRENGTH, lambda v: corpus) for x in (declared, suffix))
    out = []
    for row, d, s, h in zip(scores, declared, suffix, host, strict=True):
        logs = [row[k] + math.log(hosts[h][k] if h else corpus[k]) + (math.log(said[d][k] / corpus[k]) if d else 0) + (math.log(ended[s][k] / corpus[k]) if s else 0) for k in kinds]
        total = sum(math.exp(x - max(logs)) for x in logs)
        out.append((logs.index(max(logs)), 1 / total))
    return out


def test_fusion_against_brute_force(spark, docs):
    model = langid.fit_text_model(docs, "lang", "text", "doc_id")
    texts = [r.text[:n] for r, n in zip(docs.orderBy("doc_id").limit(40).collect(), [3, 5, 8, 12, 300] * 8, strict=True)]
    rng = np.random.default_rng(3)
    pick = lambda values: [None if (v := str(x)) == "-" else v for x in rng.choice(values, 40)]
    declared, suffix, host = pick(["en", "fr", "-"]), pick([".de", "/es", "-"]), pick(["a.x.org", "b.x.org", "c.net", "-"])
    rows = spark.createDataFrame(list(zip(range(40), texts, declared, suffix, host, strict=True)), "doc_id long, text string, d string, s string, h string")
    got = {r.doc_id: r for r in langid.identify(rows, model, declared=F.col("d"), suffix=F.col("s"), host=F.col("h")).collect()}
    scores = []
    for text in texts:
        bucket = langid._trigrams(np.frombuffer(f" {text} ".encode(), dtype=np.uint8))[0]
        raw = [float(model.tables[0, k][bucket].astype(float).mean()) * min(len(bucket), langid.MOST_TRIGRAMS) * langid.WEIGHT for k in range(len(model.languages))]
        scores.append([x - max(raw) for x in raw])
    assert all(len(s) == 4 for s in scores)
    for i, (best, sure) in enumerate(brute_posteriors(scores, declared, suffix, host)):
        assert got[i].lang == model.languages[best] and abs(got[i].confidence - sure) < 1e-4


def test_sample_is_bounded_and_labels_are_judged_by_the_other_fold(spark):
    rows = [(7, "the same english text " * 5, "en")] * 500 + [(i, f"un texte en langue {i} avec des mots", "fr") for i in range(300)]
    rows += [(1000 + i, "der kleine text mit vielen langen worten", "xx") for i in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit_text_model(df, "lang", "text", "doc_id", sample=50, folds=2)
    assert model.languages == ("en", "fr", "xx") and model.tables.shape == (2, 3, langid.BUCKETS)
    flat = np.isclose(model.tables, -math.log(langid.BUCKETS)).all(axis=2)
    assert flat[:, 0].sum() == 1  # the one english text is known to the other fold only
    judged = langid.identify(df.withColumn("source", F.lit("s")), model, declared=F.col("lang")).groupBy("lang").count().collect()
    assert {r.lang for r in judged} >= {"en", "fr"}


def test_language_odd_input(odd, empty):
    rows = langid.identify_documents(odd).collect()
    assert len(rows) == 13
    kept = langid.reject_unidentified(odd)
    assert kept.columns == odd.columns
    assert langid.identify_documents(empty).count() == 0 and langid.reject_unidentified(empty).count() == 0


def test_long_texts_score_like_their_pieces(spark, docs):
    model = langid.fit_text_model(docs, "lang", "text", "doc_id")
    text = "the and of to in that it is was for " * 80_000  # several pieces
    rows = langid.identify(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).collect()
    assert rows[0].text_lang == "en"
