"""Hooks for models of the user's own: token counters (U1) and taggers.

A hook works on whole Arrow batches, in the tasks: it gets a column and gives one
back, so no value becomes a Python object unless the hook asks for it. Repeated
values of a batch reach a counter once. Nulls count no tokens and have no tags.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

from .. import constants as K

TAGGED = "array<struct<token:string,tag:string>>"


def token_counter(count: Callable[[pa.Array], pa.Array]) -> Callable[[Column], Column]:
    """``count`` takes a column of texts and gives their numbers of tokens; the
    result goes into ``features(token_counter=...)``."""

    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        once = texts.dictionary_encode()
        return count(once.dictionary).take(once.indices).cast(pa.int64()).fill_null(0)

    return run


def piece_counts(texts: pa.Array) -> pa.Array:
    """Tokens of a subword vocabulary without its files: every word (between
    spaces) is cut into pieces of at most PIECE_CHARS characters, and each text has
    PIECE_SPECIALS marks."""
    words = pc.split_pattern(texts, " ")
    pieces = pc.utf8_length(words.flatten()).to_numpy(zero_copy_only=False).astype(np.int64)
    upto = np.concatenate(([0], np.cumsum(-(-pieces // K.PIECE_CHARS))))
    ends = np.concatenate(([0], np.cumsum(pc.list_value_length(words).fill_null(0).to_numpy(zero_copy_only=False))))
    return pa.array(upto[ends[1:]] - upto[ends[:-1]] + K.PIECE_SPECIALS, pa.int64())


def tagger(tag: Callable[[pa.Array], pa.Array]) -> Callable[[Column], Column]:
    """``tag`` takes a column of word lists, so that it can look at neighbours,
    and gives one tag for each word of all lists, in order; the result is the tagged
    column that ``features(tags_col=...)`` reads."""

    @F.arrow_udf(TAGGED)
    def run(words: pa.Array) -> pa.Array:
        lists = words.fill_null(pa.scalar([], words.type))
        tokens = lists.flatten()
        ends = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))).astype(np.int32)
        pairs = pa.StructArray.from_arrays([tokens, tag(lists).cast(pa.string())], ["token", "tag"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)

    return run


def suffix_tags(words: pa.Array) -> pa.Array:
    """A tagger without a lexicon: the first of SUFFIX_TAGS that ends a word."""
    once = words.flatten().dictionary_encode()
    rules = pc.make_struct(*[pc.ends_with(once.dictionary, pattern=end) for end, _ in K.SUFFIX_TAGS])
    tags = pc.case_when(rules, *[pa.scalar(tag) for _, tag in K.SUFFIX_TAGS], pa.scalar(K.SUFFIX_REST))
    return pa.array([], pa.string()) if not len(once) else tags.take(once.indices)
