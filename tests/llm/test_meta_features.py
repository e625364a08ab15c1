"""Sources by host stay apart in the metadata view."""

import numpy as np

from bookmill.llm import quality


def test_sources_that_share_their_end_are_different_features():
    hosts = [f"{x}.example.com" for x in ("news", "shop", "blog", "wiki", "mail", "docs")]
    rows = quality.meta_features(hosts, [None] * 6, [None] * 6)
    assert len(np.unique(rows, axis=0)) >= 5  # of 256 buckets; at most one collision
    assert (rows == quality.meta_features(hosts, [None] * 6, [None] * 6)).all()
    assert not (
        quality.meta_features(
            ["longer than six"], [None], [None]
        ) == quality.meta_features([None], ["longer than six"], [None])
    ).all()
