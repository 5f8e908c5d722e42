"""The pipeline against its stages written plainly, and on awkward rows."""

import re
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import awkward
import corpus_pipeline as pipe
from tidemark.llm import language_id, line_dedup, secret_scan
from test_llm_text import ASSIGN, plain_join

WORDS = public_tokenizers.path("word_bpe_49k.json")


def stages(spark, docs, sf_dir, tmp_path):
    out = [docs]
    for k, (_, f) in enumerate(pipe.STAGES):
        f(spark, out[-1], sf_dir).write.parquet(str(tmp_path / str(k)))
        out.append(spark.read.parquet(str(tmp_path / str(k))))
    return out


def plain_masked(text):
    spans = [(m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    spans += [m.span() for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [m.span() for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    out, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            out += [text[at:start], pipe.MASK]
        at = max(at, end)
    return "".join([*out, text[at:]])


def passages(lines, least=50):
    """All (begin, end) with ``least`` words that have fewer without their first line or without their last one."""
    words = [len(x.split()) for x in lines]
    for a in range(len(lines)):
        for e in range(a + 1, len(lines) + 1):
            total = sum(words[a:e])
            if words[a] and words[e - 1] and total >= least and (total - words[a] < least or total - words[e - 1] < least):
                yield a, e
            if total >= least + words[a]:
                break


def plain_lines(texts):
    """Texts without lines that a document of a smaller id holds in a chunk or a passage of 50 words, or an earlier place."""
    cut = {i: (t or "").split("\n") for i, t in texts.items()}
    found = {}
    for i, lines in cut.items():
        chunks = [(a, e) for a, e, may_go in line_dedup.chunks(texts[i] or "", line_dedup.PASSAGES) if may_go]
        found[i] = {(a, e): "\n".join(lines[a:e]) for a, e in {*chunks, *passages(lines)}}
    keeper = {}
    for i, of in found.items():
        for content in of.values():
            keeper[content] = min(i, keeper.get(content, i))
    out = {}
    for i, of in found.items():
        gone = set()
        for (a, e), content in of.items():
            earlier = any(c == content and end <= a for (_, end), c in of.items())
            if keeper[content] < i or earlier:
                gone.update(range(a, e))
        out[i] = texts[i] if not gone else "\n".join(x for k, x in enumerate(cut[i]) if k not in gone)
    return out


@pytest.fixture(scope="module")
def results(spark, sf_dir, tmp_path_factory):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return stages(spark, docs, sf_dir, tmp_path_factory.mktemp("stages"))


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_every_stage_keeps_the_columns_of_documents(results):
    for df in results[1:-1]:
        assert df.columns == results[0].columns
        assert [f.dataType for f in df.schema] == [f.dataType for f in results[0].schema]


def test_stages_equal_plain_versions(results):
    docs, spoken, lined, single, masked = map(rows, results[:-1])
    packed = results[-1].collect()
    # Language ID: only und and narrow margins go, and most of what stays has its own language.
    learned = language_id.learn(results[0].where("pmod(crc32(string(doc_id)), 4) <> 2"))
    tool, names = language_id.Compressor(learned, language_id.Settings()), list(learned)
    for i, r in docs.items():
        sizes = tool.sizes(r.text) if re.search(r"[^\W\d_]", r.text) else None
        best = sorted(sizes)[:2] if sizes else None
        stays = bool(best) and best[1] / best[0] - 1 >= language_id.Settings().margin
        assert (i in spoken) == stays
        if stays:
            assert spoken[i].lang == names[sizes.index(best[0])] and spoken[i].text == r.text
    # Line dedup: documents that consist of repetitions go.
    want = plain_lines({i: r.text for i, r in spoken.items()})
    want = {i: t for i, t in want.items() if t or not spoken[i].text}
    assert {i: r.text for i, r in lined.items()} == want
    assert all(r.n_chars == len(r.text) for r in lined.values())
    kept = {i for i, x in plain_join([(i, r.text) for i, r in lined.items()]).items() if x[3]}
    assert set(single) == kept
    found = {r.doc_id: r.found for r in secret_scan.scan(results[3]).collect()}
    assert set(masked) == set(single)
    for i, r in masked.items():
        if all(s.kind < 3 for s in found[i]):
            assert r.text == plain_masked(single[i].text)
        else:
            assert r.text.count(pipe.MASK) > plain_masked(single[i].text).count(pipe.MASK)
    tokenizer = Tokenizer.from_file(WORDS)
    ids = {}
    for p in sorted(packed, key=lambda p: (p.doc_id, p.start)):
        ids.setdefault(p.doc_id, []).extend(p.ids)
    assert ids == {i: [*tokenizer.encode(r.text, add_special_tokens=False).ids, 1] for i, r in masked.items()}


def test_awkward_rows_pass_through_every_stage(spark, sf_dir, tmp_path):
    out = stages(spark, awkward.table(spark), sf_dir, tmp_path / "a")
    assert all(df.columns == out[0].columns for df in out[:-1])
    ids = [Counter(r.doc_id for r in df.collect()) for df in out]
    assert ids[1][8] == ids[2][8] == 2 and not ids[1].keys() & {3, 4, 5, 9}
    assert 7 not in ids[3] and 6 in ids[3] and 14 not in ids[3]
    texts = {r.doc_id: r.text for r in out[4].collect()}
    assert texts[11] == f"密码 {pipe.MASK}'\n日本語🎉" and pipe.MASK in texts[15]
    empty = stages(spark, awkward.table(spark, []), sf_dir, tmp_path / "b")
    assert [df.count() for df in empty] == [0] * 6
