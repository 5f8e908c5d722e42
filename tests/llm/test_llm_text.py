"""Language ID, line dedup, secret scan, exact dedup and n-gram join against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

import awkward
from tidemark.llm import exact_dedup, language_id, line_dedup, ngram_join, secret_scan


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


# -- language ID -----------------------------------------------------------------------


def test_language_of_held_out_texts(spark, sf_dir):
    docs = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + "/documents.parquet")
    learned = language_id.learn(docs.where("pmod(crc32(string(doc_id)), 4) <> 2"))
    assert set(learned) == {"en", "de", "fr", "es"}
    held = docs.where("pmod(crc32(string(doc_id)), 4) = 2")
    found = language_id.identify(held, learned).join(held.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang_pred == r.lang for r in found) >= 0.95 * len(found)
    assert sum(r.rejected for r in found) <= 0.03 * len(found)
    assert all(0 <= r.score <= 1 for r in found)


def test_language_of_awkward_rows(spark):
    table = awkward.table(spark)
    learned = language_id.learn(table)
    assert set(learned) == {"en", "fr"}
    found = language_id.identify(table, learned).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, _, _ in awkward.TEXTS)
    for r in found:
        if r.doc_id in (3, 4, 5, 9):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
    assert {r.lang_pred for r in found if r.doc_id in (1, 2, 6)} == {"en"}
    assert {r.lang_pred for r in found if r.doc_id == 8} == {"fr"}
    assert language_id.learn(awkward.table(spark, [])) == {}
    assert {r.lang_pred for r in language_id.identify(table, {}).collect()} == {"und"}
    assert language_id.identify(awkward.table(spark, []), learned).count() == 0


def test_equal_sizes_are_rejected():
    same = language_id.Compressor({"a": b"some words", "b": b"some words"}, language_id.Settings())
    assert len(set(same.sizes("some words here"))) == 1


# -- line dedup ------------------------------------------------------------------------


def plain_dedup(rows, settings):
    owners = defaultdict(set)
    for i, text in rows:
        for _, content in line_dedup.removable(text or "", settings):
            if i is not None:
                owners[content].add(i)
    out = []
    for i, text in rows:
        if text is None:
            out.append((i, None))
            continue
        lines, kept, seen = text.split("\n"), [], set()
        for begin, end, may_go in line_dedup.chunks(text, settings):
            content = "\n".join(lines[begin:end])
            if may_go and (content in seen or (i is not None and min(owners[content]) != i)):
                continue
            seen.add(content)
            kept += lines[begin:end]
        out.append((i, "\n".join(kept)))
    return out


def test_line_dedup_equals_a_plain_version(docs):
    got = line_dedup.line_dedup(docs).select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, got)) == sorted(plain_dedup(rows, line_dedup.Settings()))


def test_passages_stay_once_and_shifts_do_not_hide_chunks(spark):
    draw = random.Random(4)
    line = lambda n: " ".join(f"w{draw.randrange(10**6)}" for _ in range(n))
    passage = line(60)
    block = [line(8) for _ in range(40)]
    rows = [(k, "\n".join([line(9), passage, line(7)]), "en") for k in range(30)]
    rows += [(100, "\n".join([line(5), *block, line(6)]), "en"), (101, "\n".join([line(5), line(4), *block[:20], line(3), *block[20:]]), "en")]
    table = awkward.table(spark, rows)
    got = {r.doc_id: r.text for r in line_dedup.line_dedup(table).collect()}
    assert [k for k in range(30) if passage in got[k]] == [0]
    assert all(got[k].count("\n") == 1 for k in range(1, 30))
    left = got[101].split("\n")
    assert got[100].count("\n") == 41 and len(left) < 24  # most of the forty shared lines are gone, though shifted


def test_line_dedup_of_awkward_rows(spark):
    table = awkward.table(spark)
    got = line_dedup.line_dedup(table)
    assert got.columns == table.columns
    rows = [(i, t) for i, t, _ in awkward.TEXTS]
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter(plain_dedup(rows, line_dedup.Settings()))
    assert all(r["a.b"] == 4 and r.key == "k" for r in got.collect())
    assert line_dedup.line_dedup(awkward.table(spark, [])).count() == 0


# -- secrets ---------------------------------------------------------------------------

ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain_base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    found.sort()
    names = ("assign", "access", "hex")
    joined = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in found)
    return *(sum(x[1] == k for x in found) for k in range(3)), hashlib.sha256(joined.encode()).hexdigest()


CASES = [
    "PassWord: 'abcdefgh", "token==abc12345 token=token:abcdefghijk", "AKIAAKIA12345678901 AKIA123", "é🎉 secret = abcdefgh1",
    'api_key="abc.def/gh', "ſecret: abcdefgh1 toKen=abcdefgh2", "token: ' x=abcdefghijk", "0123456789abcdef0123456789abcdef0123",
    "token=abc12345 " * 300, "password=\npasswd:12345678", "apikey:=:abcdefghij",
]


def test_base_spans_equal_plain_regexes(spark, docs, texts):
    cases = awkward.table(spark, [(10**6 + k, t, None) for k, t in enumerate(CASES)] + awkward.TEXTS)
    both = docs.select("doc_id", "text").unionByName(cases.select("doc_id", "text"))
    got = secret_scan.secret_digests(both).collect()
    want = Counter((r.doc_id, *plain_base(r.text)) for r in both.collect())
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == want


def test_battery_flags_random_tokens_and_leaves_words(spark):
    draw = random.Random(7)
    token = lambda n, letters: "".join(draw.choice(letters) for _ in range(n))
    alphabets = [a for _, a in secret_scan.ALPHABETS]
    rows = [(k, f"see {token(48, alphabets[k % 8])} there", "en") for k in range(160)]
    slugs = ["some-long-page-slug-with-number-2-and-more-words", "aaaaaaaaaaaaaaaaaaaa1aaaaaaaaaaaaaaaaaaaaaaaa", "informationretrievalsystemsandtheirusers2"]
    rows += [(1000 + k, f"go to {slugs[k % 3]} now", "en") for k in range(90)]
    got = {r.doc_id: r.spans for r in secret_scan.secret_digests(awkward.table(spark, rows)).collect()}
    kinds = {k: got[k].split(":")[0] for k in range(160)}
    assert sum(v in ("random", "hex") for v in kinds.values()) >= 150
    assert sum("random" in got[1000 + k] for k in range(90)) == 0
    assert all(got[k] in ("random:4:52", "hex:4:52") for k in range(160) if kinds[k])
    assert secret_scan.secret_digests(awkward.table(spark, [])).count() == 0


# -- exact dedup -----------------------------------------------------------------------


def plain_groups(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(lower)].append(i)
    out = Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            out[(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest())] += 1
    return out


def test_exact_dedup_of_awkward_rows(spark, docs, tmp_path):
    rows = [(i, t) for i, t, _ in [*awkward.TEXTS, (20, "ÉTÉ Ab", None), (21, "ÉTÉ aB", None), (22, "été ab", None)]]
    table = awkward.table(spark, [(i, t, None) for i, t in rows])
    got = exact_dedup.exact_dedup(table, str(tmp_path / "i"), 3).collect()
    assert Counter(map(tuple, got)) == plain_groups(rows)
    assert exact_dedup.exact_dedup(awkward.table(spark, []), str(tmp_path / "j"), 3).count() == 0


def test_index_outlives_its_opener_and_knows_earlier_batches(spark, docs, tmp_path):
    path = str(tmp_path / "index")
    exact_dedup.DigestIndex(spark, path, 4).add(docs.where("doc_id % 2 = 0")).count()
    second = exact_dedup.DigestIndex(spark, path, 4)
    before = second.rows().count()
    out = {r.doc_id: r for r in second.add(docs.where("doc_id % 2 = 1")).collect()}
    rows = [(r.doc_id, r.text.lower()) for r in docs.collect()]
    even = {t for i, t in rows if i % 2 == 0}
    assert all(out[i].kept is False and out[i].keep_id % 2 == 0 for i, t in rows if i % 2 and t in even)
    assert second.rows().count() == len({t for _, t in rows}) > before
    again = {r.doc_id: r.kept for r in second.add(docs.where("doc_id % 2 = 1")).collect()}
    assert again == {i: r.kept for i, r in out.items()} and second.rows().count() == len({t for _, t in rows})


def test_anti_join_sorts_and_moves_only_the_batch(spark, docs, tmp_path):
    index = exact_dedup.DigestIndex(spark, str(tmp_path / "k"), 4)
    index.add(docs).count()
    batch = docs.selectExpr("unhex(sha2(text, 256)) AS digest").join(index.rows().hint("merge"), "digest", "left_anti")
    plan = batch._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and plan.split("== Physical Plan ==")[1].count("Exchange hashpartitioning") == 1


# -- n-gram join -----------------------------------------------------------------------


def plain_join(rows, n=5, least=0.8):
    groups = defaultdict(list)
    for i, t in rows:
        words = (t or "").encode().lower().split()
        grams = frozenset(tuple(words[k:k + n]) for k in range(max(1, len(words) - n + 1))) if words else ("none", i)
        groups[grams].append(i)
    sets = list(groups)
    near = {a: set() for a in range(len(sets))}
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if isinstance(x, frozenset) and isinstance(y, frozenset) and len(x & y) >= least * len(x | y):
                near[a].add(b)
                near[b].add(a)
    out, seen = {}, {}
    for a in near:
        if a not in seen:
            stack, found = [a], {a}
            while stack:
                for b in near[stack.pop()] - found:
                    found.add(b)
                    stack.append(b)
            low = min(min(groups[sets[x]]) for x in found)
            seen |= dict.fromkeys(found, low)
        ids = groups[sets[a]]
        links = len(ids) - 1 + sum(len(groups[sets[b]]) for b in near[a])
        out |= {i: (seen[a], min(ids), links, i == seen[a]) for i in ids}
    return out


def test_join_equals_a_plain_version(docs, texts):
    got = {r.doc_id: (r.class_id, r.copy_id, r.n_links, r.kept) for r in ngram_join.ngram_join(docs).collect()}
    assert got == plain_join(texts.items())


@pytest.mark.parametrize("block", [64, 7])
def test_no_link_is_lost_in_a_large_group_of_near_copies(spark, block):
    draw = random.Random(9)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for k in range(220):
        words = list(base)
        for _ in range(draw.randrange(5)):
            words[draw.randrange(150)] = f"x{draw.randrange(10**6)}"
        rows.append((k, " ".join(words)))
    rows += [(1000 + k, " ".join(f"y{draw.randrange(10**6)}" for _ in range(80)) + " " + " ".join(base[:20])) for k in range(60)]
    table = awkward.table(spark, [(i, t, None) for i, t in rows])
    found = ngram_join.ngram_join(table, ngram_join.Settings(block=block)).collect()
    assert {r.doc_id: (r.class_id, r.copy_id, r.n_links, r.kept) for r in found} == plain_join(rows)


def test_join_of_awkward_rows(spark):
    found = ngram_join.ngram_join(awkward.table(spark)).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, _, _ in awkward.TEXTS)
    by_id = {r.doc_id: r for r in found}
    assert (by_id[2].class_id, by_id[7].class_id, by_id[14].class_id) == (1, 6, 13)
    assert all((r.class_id, r.n_links, r.kept) == (r.doc_id, 0, True) for r in found if r.doc_id in (3, 4, 5, None))
    assert by_id[8].n_links == 1
    assert ngram_join.ngram_join(awkward.table(spark, [])).count() == 0


def test_bands_reach_the_target_recall():
    s = ngram_join.Settings()
    assert 1 - (1 - s.similarity**s.rows) ** s.bands >= s.recall
