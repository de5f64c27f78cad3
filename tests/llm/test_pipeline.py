import re
from collections import Counter, defaultdict

import pytest
from test_mixing import slow_targets
from test_packing import exact, verify  # noqa: F401
from test_simhash import reach, slow_fingerprint

import corpus_pipeline
from traitrank.llm.line_dedup import MAX_RATIO, MIN_PAGES
from traitrank.llm.queries import llm_queries
from traitrank.sources.staging import Staging

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """What goes into the first stage and what each stage returns."""
    staging = Staging(spark)
    out = [spark.read.parquet(f"{SF_DIR}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(staging.write(stage(spark, out[-1], SF_DIR), name))
    return out


def test_documents_keep_their_columns(stages):
    assert all(df.dtypes == stages[0].dtypes for df in stages[1:-1])


def test_rejected_documents_go(spark, stages):
    good = {r.doc_id for r in llm_queries()["op10_quality"](spark, SF_DIR).collect() if r.predicted}
    assert {r.doc_id for r in stages[1].collect()} == good
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    clean = [i for i, q in labels.items() if q == 1]
    assert sum(i in good for i in clean) >= 0.97 * len(clean)


def test_boilerplate_lines_go(stages):
    pages, on = Counter(), Counter()
    rows = stages[1].collect()
    for r in rows:
        pages[r.source] += 1
        on.update({(r.source, line.strip(" \t\r")) for line in r.text.split("\n")})
    gone = {k for k, n in on.items() if k[1] and n >= MIN_PAGES and n > MAX_RATIO * pages[k[0]]}
    expected = {r.doc_id: "\n".join(x for x in r.text.split("\n") if (r.source, x.strip(" \t\r")) not in gone) for r in rows}
    got = stages[2].collect()
    assert {r.doc_id: r.text for r in got} == expected and gone
    assert all(r.n_chars == len(r.text) for r in got)


def test_one_of_near_copies_stays(stages):
    prints = [(slow_fingerprint(r.text), r.doc_id) for r in stages[2].collect()]
    component = reach(prints, 3)
    assert sorted(r.doc_id for r in stages[3].collect()) == sorted(i for i, c in component.items() if i == c)


def test_sources_meet_their_targets(stages):
    size = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text))
    before, after = defaultdict(int), defaultdict(int)
    for r in stages[3].collect():
        before[r.source] += size(r.text)
    copies = Counter()
    for r in stages[4].collect():
        after[r.source] += size(r.text)
        copies[r.doc_id] += 1
    assert max(copies.values()) <= 3
    for source, goal in slow_targets(before).items():
        assert after[source] == pytest.approx(goal, rel=0.02)


def test_all_copies_are_packed(stages, exact):  # noqa: F811
    copies = Counter(r.doc_id for r in stages[4].collect())
    lengths = Counter()
    for r in stages[5].collect():
        lengths[r.doc_id] += r.length
    for r in stages[4].dropDuplicates(["doc_id"]).collect():
        assert lengths[r.doc_id] == copies[r.doc_id] * (len(exact(r.text)) + 1)
    once = [n for n in Counter(r.sequence_id for r in stages[5].collect()).values()]
    assert len(once) * 1024 >= sum(lengths.values())


def test_run_gives_the_last_stage(spark, stages):
    def row(r):
        return r.doc_id, r.start, r.length, r.ids_crc32

    assert sorted(map(row, corpus_pipeline.run(spark, SF_DIR).collect())) == sorted(map(row, stages[-1].collect()))
