"""Findings of the second review on the training-text operators."""

from __future__ import annotations

import random
from itertools import product

import numpy as np
import pytest

from corpusflow.llm import language_id, licenses, lm_score, url_filter


def test_lm_pairs_beyond_the_bound_still_count(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randrange(1, 4) for _ in range(rng.randrange(1, 50))) for _ in range(80)]
    docs = spark.createDataFrame([*enumerate(texts), (900, None), (901, "")], "doc_id long, text string").repartition(3)
    whole, small = lm_score.train(docs), lm_score.train(docs, max_filter_bytes=1 << 10, segment_text=64)
    assert whole.rare is None and small.filter.value.cutoff > 1
    assert small.filter.value.segment_bits > lm_score.SEGMENT_BITS == whole.filter.value.segment_bits
    slabs = list(small.slabs())
    assert len(slabs) > 1 and [s.first for s in slabs] == sorted({s.first for s in slabs})
    want, got = ({r.doc_id: r for r in lm_score.score(docs, m).collect()} for m in (whole, small))
    assert len(got) == 82
    for k, r in got.items():
        assert (r.n_tokens, r.n_known, r.train_tokens) == (want[k].n_tokens, want[k].n_known, want[k].train_tokens)
        assert r.base_score == pytest.approx(want[k].base_score)
    off = lambda rows: np.mean([abs(rows[k].score - want[k].score) / want[k].n_tokens for k in want])
    small.rare = None
    cut = {r.doc_id: r for r in lm_score.score(docs, small).collect()}
    assert off(got) < 0.1 * off(cut)  # both filters' few overestimates differ


def _strings(pattern):
    """Strings that an expression of the license tables accepts: all branches, options with and without."""
    from re import _constants as c, _parser
    def one(op, arg):
        if op is c.LITERAL:
            return [chr(arg)]
        if op is c.IN:
            return [chr(x if o is c.LITERAL else x[0]) for o, x in arg]
        if op is c.SUBPATTERN:
            return many(arg[3])
        if op is c.BRANCH:
            return [x for part in arg[1] for x in many(part)]
        low, high, part = arg
        return [x * n for n in sorted({low, min(high, low + 1)}) for x in many(part)]
    many = lambda parts: ["".join(x) for x in product(*[one(*p) for p in parts])]
    return many(_parser.parse(pattern))


def test_every_alternative_of_every_license_rule_is_found_alone():
    for label, keys, name in licenses.LICENSES:
        for text in sorted(set(_strings(name))):
            assert any(k in text for k in keys.split("|")), (label, text)
            labels = [x[2] for x in licenses.detections(text)]
            assert label in labels, (label, text, labels)


@pytest.mark.parametrize("text, want", [
    ("SPDX-License-Identifier: MIT", "mit"), ("SPDX-License-Identifier: ISC", "isc"), ("SPDX-License-Identifier: Zlib", "zlib"), ("SPDX-License-Identifier: BSL-1.0", "boost-1.0"),
    ("SPDX-License-Identifier: OFL-1.1", "ofl-1.1"), ("SPDX-License-Identifier: MPL-1.1", "mpl-1.1"), ("SPDX-License-Identifier: CDDL-1.0", "cddl-1.0"),
    ("SPDX-License-Identifier: EPL-2.0", "epl-2.0"), ("SPDX-License-Identifier: (MIT OR Apache-2.0) AND ISC", "mit,apache-2.0,isc"), ("licensed under MIT.", "mit"),
    ("distributed under the GNU GPL", "gpl"), ("Expat License", "mit"), ("PNG Reference Library License", "libpng"), ("Apache License 2.0", "apache-2.0"), ("gpl-1.0-only", "gpl-1.0"),
    ("GNU GPL version 2", "gpl-2.0"), ("available under X11 on Linux", ""), ("licensed under MIT-Modern-Variant", ""), ("SPDX-License-Identifier: nothing", "")])
def test_license_notices(text, want):
    assert ",".join(x[2] for x in licenses.detections(text)) == want


def test_every_spdx_id_is_found():
    for name, label in licenses.IDS.items():
        assert [x[2] for x in licenses.detections(f"# SPDX-License-Identifier: {name.upper()}\n")] == [label]
        assert label in [x[2] for x in licenses.detections(f"licensed under {name}.")]


@pytest.mark.parametrize("sections, per_section", [(5, 1), (60, 1), (60, 12), (400, 12)])
def test_url_rules_of_a_section_say_nothing_about_others(spark, sections, per_section):
    names = ["es", "fr", "en", "de", *(chr(97 + i % 26) + chr(97 + i // 26) + "q" for i in range(sections))]
    urls = [f"http://site.net/{s}/{i}" for s in names for i in range(per_section)] + [f"http://site.net/en/{i}" for i in range(100)]
    got = url_filter.judge(spark.createDataFrame([*enumerate(urls)], "page_id long, url string").repartition(3)).collect()
    assert len(got) == len(urls)
    for r in got:
        assert r.verdict == ("block" if r.path.startswith(("/es/", "/fr/")) else "allow"), r
    assert len({r.template for r in got}) <= 4 * url_filter.BRANCHES + 4


def test_url_sections_with_many_labels_are_judged_alone(spark):
    urls = [f"http://big.org/{chr(97 + i % 26)}{chr(97 + i // 26)}/{k}" for i in range(400) for k in range(10)]
    labels = spark.createDataFrame([(f"http://big.org/aa/{k}", True) for k in range(20)] + [(f"http://big.org/ba/{k}", False) for k in range(20)], "url string, bad boolean")
    got = url_filter.judge(spark.createDataFrame([*enumerate(urls)], "page_id long, url string"), labels=labels).collect()
    assert {r.path.split("/")[1] for r in got if r.verdict == "block"} == {"aa"}
    assert {r.template for r in got} == {"/*/{n}", "/*{block}/{n}", "/*{allow}/{n}"}


def test_language_of_copies_keeps_its_label(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(language_id.Network, "train", lambda net, words, y, weights, **options: seen.append((net.labels, words, y.tolist())))
    many = spark.range(30000).selectExpr("concat('kopie', id % 3) AS text", "'de' AS lang")
    more = spark.range(3000).selectExpr("concat('copy', id) AS text", "'en' AS lang")
    language_id.train(many.union(more), per_language=2)
    (labels, words, y), = seen
    assert labels == ["de", "en"] and y.count(0) == y.count(1) == 2 and len(set(words)) == 4
    seen.clear()
    language_id.train(many.union(many.limit(5).selectExpr("'einzig' AS text", "lang")), per_language=10)
    assert sorted(seen[0][1]) == [b"einzig", b"kopie0", b"kopie1", b"kopie2"]


def test_language_sample_reads_the_whole_text(spark):
    words = [f"w{i:05}" for i in range(4000)]
    df = spark.createDataFrame([(" ".join(words),), ("short text",), ("x" * 9000,)], "text string")
    long, short, one = [r[0] for r in df.select(language_id._sample(df.text, 4000)).collect()]
    got = long.split()
    assert set(got) <= set(words) and got == sorted(got) and 3000 < len(long) <= 4000 + language_id.PIECES
    assert got[0] == words[0] and got[-1] == words[-1] and any("w01900" < w < "w02400" for w in got)
    assert short == "short text" and 4000 <= len(one) <= 4000 + language_id.PIECES


def test_without_labels_texts_with_a_letter_stay(spark):
    docs = spark.createDataFrame([(1, "some text", None), (2, "12 ?", None), (3, None, None), (4, "", None), (5, "日本", None)], "doc_id long, text string, lang string")
    net = language_id.train(docs)
    kept = language_id.drop_unidentified(docs, net)
    assert net is None and kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 5]
