"""Text operators against brute force on small rows: nulls, empty and long texts, ties, repeats, clashing columns."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataline.llm import op1_packing, op4_token_files, op5_substrings, op6_language, op8_simhash, op9_licences, op10_mixing
from strataline.llm.shared import folder_for
from strataline.llm.tokens import Encoder, encoder, vocabulary_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, ids string, fingerprint string, position int"


def _texts():
    rng = random.Random(3)
    vocabulary = ["a", "b", "c", "dd", "é", "x1"]
    passage = [rng.choice(vocabulary) for _ in range(120)]
    rows = []
    for i in range(50):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 90))]
        if rng.random() < 0.6:
            at = rng.randint(0, 60)
            words += passage[at:at + rng.randint(30, 60)] + [rng.choice(vocabulary) for _ in range(5)]
        if rng.random() < 0.2:
            words += ["z"] * rng.randint(30, 60)
        rows.append((i, rng.choice([" ", "\n", "\t  "]).join(words)))
    long = " ".join(rng.choice(vocabulary) for _ in range(30_000))
    return rows + [(100, None), (101, ""), (3, rows[3][1]), (None, rows[4][1]), (None, None), (102, "one"), (103, long)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "de", None][(i or 0) % 3], ["s1", "s2", None][(i or 0) % 3], "x", "y", 1) for i, t in _texts()]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("window", [35, 12])
def test_repeated_windows(docs, window):
    split = [(i, WORD.findall(t or "")) for i, t in _texts()]
    seen = Counter(tuple(d[k:k + window]) for _, d in split for k in range(len(d) - window + 1))
    want = []
    for i, d in split:
        gone = {p for k in range(len(d) - window + 1) if seen[tuple(d[k:k + window])] > 1 for p in range(k, k + window)}
        want.append((i, len(d), len(gone), " ".join(w for p, w in enumerate(d) if p not in gone)))
    got = [tuple(r) for r in op5_substrings.remove_repeats(docs, window).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("cell_pairs", [48, 1])
def test_simhash_groups(docs, cell_pairs, monkeypatch):
    monkeypatch.setattr(op8_simhash.links, "__defaults__", (cell_pairs,))
    prints = [(i, op8_simhash.fingerprint(t)) for i, t in _texts()]
    group = list(range(len(prints)))
    for _ in prints:
        for a in range(len(prints)):
            for b in range(a):
                if (prints[a][1] ^ prints[b][1]).bit_count() <= 2:
                    group[a] = group[b] = min(group[a], group[b])
    members = defaultdict(list)
    for (i, _), g in zip(prints, group):
        members[g].append(i)
    want = [(i, f"{f:016x}", min((m for m in members[g] if m is not None), default=None)) for (i, f), g in zip(prints, group)]
    got = [tuple(r)[:3] for r in op8_simhash.near_duplicates(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_fingerprint_is_the_majority_of_hashes():
    import xxhash

    words = "The Quick brown fox É jumps".translate(str.maketrans("TQ", "tq")).split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(len(words) - 2)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert op8_simhash.fingerprint("The Quick brown fox É jumps") == want
    assert op8_simhash.fingerprint(None) == op8_simhash.fingerprint(" \n") == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_gives_the_library_s_ids(name):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary_path(name))
    library.encode_special_tokens = True
    encoder, rng = Encoder(vocabulary_path(name)), random.Random(1)
    alphabet = " \t\n'’abstrevmldSTREÉñß²³12½—…!?.,<|>«»\xad\xa0日"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(800)] + ["<|endoftext|>", "''s x\x1cy"]
    for text in texts:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_splits_every_safe_character_like_the_library(name):
    from tokenizers import Tokenizer

    from strataline.llm.tokens import _SAFE

    library, own, rng = Tokenizer.from_file(vocabulary_path(name)), encoder(vocabulary_path(name)), random.Random(2)
    safe = [c for c in map(chr, range(0x2100)) if _SAFE.fullmatch(c)]
    texts = safe + [a + b for a in safe for b in rng.sample(safe, 4)] + ["".join(rng.choices(safe, k=40)) for _ in range(300)]
    for text in [*texts, "Əli Ɓala $Ⱥ", "K ẞ Å İ"]:
        got = np.frombuffer(own.encode(text), "<u4").tolist()
        assert got == library.encode(text, add_special_tokens=False).ids, text


def test_pieces_are_not_normalised_and_split_again():
    own = Encoder(vocabulary_path("word_bpe_49k.json"))
    own._library = None  # what only texts beyond the safe characters need
    assert own.encode("Two words, 12 of them") == Encoder(vocabulary_path("word_bpe_49k.json")).encode("Two words, 12 of them")


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_keeps_few_and_short_pieces(name, monkeypatch):
    from tokenizers import Tokenizer

    from strataline.llm import tokens

    monkeypatch.setattr(tokens, "KEPT_PIECES", 3)
    library, own = Tokenizer.from_file(vocabulary_path(name)), Encoder(vocabulary_path(name))
    for text in ("one two three four five one two", "six seven one", "one " + "ab" * 5000 + " two", "é" * 300 + "\n five"):
        for _ in range(2):
            assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
            assert len(own._kept) <= 3 and max(map(len, own._kept)) <= 64


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_takes_added_tokens_as_the_library_does(name):
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(vocabulary_path(name)), encoder(vocabulary_path(name))  # the operators' encoder
    added = [t.content for t in library.get_added_tokens_decoder().values()]
    assert "<|endoftext|>" in added
    for token in [*added, *map(str.upper, added)]:
        for text in (token, f"some words {token}more words", f"a {token} {token}\n", f"日本 {token}", token[:-1]):
            got = np.frombuffer(own.encode(text), "<u4").tolist()
            assert got == library.encode(text, add_special_tokens=False).ids, text


def test_packing_keeps_every_id_once_within_the_limits(docs):
    limits = op1_packing.Limits(64, 4, 60)
    rows = op1_packing.pack(docs, limits).collect()
    encoder = Encoder(vocabulary_path(op1_packing.VOCABULARY))
    want = sorted(list(np.frombuffer(encoder.encode(t), "<u4")) + [0] for _, t in _texts())
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids)
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert sum(r.length for r in rows) == sum(map(len, want))
    single = [k for k, n in Counter(i for i, _ in _texts()).items() if n == 1]
    for i, text in _texts():
        if i in single:
            pieces = sorted(by_doc[i], key=lambda r: r.start)
            assert [x for r in pieces for x in r.ids] == list(np.frombuffer(encoder.encode(text), "<u4")) + [0]
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == np.cumsum([0] + [r.length for r in pieces])[:-1].tolist()
        assert sum(r.length for r in pieces) <= 64 and len(pieces) <= 4 and sum(r.loss_tokens for r in pieces) <= 60


def test_packing_equals_a_plain_encoding_with_little_padding(spark, docs):
    """The query's own limits against the unmodified library: every id of every document once, checksums, padding."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary_path(op1_packing.VOCABULARY))
    rows = [r.asDict() for r in op1_packing.pack(docs.where("doc_id is not null").dropDuplicates(["doc_id"])).collect()]
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
    texts = {r.doc_id: r.text for r in docs.where("doc_id is not null").dropDuplicates(["doc_id"]).collect()}
    assert set(by_doc) == set(texts)
    for i, text in texts.items():
        want = library.encode(text or "", add_special_tokens=False).ids + [0]
        pieces = sorted(by_doc[i], key=lambda r: r["start"])
        assert [x for r in pieces for x in r["ids"]] == want and {r["doc_tokens"] for r in pieces} == {len(want)}
        assert all(r["ids_crc32"] == zlib.crc32(np.array(want[r["start"]:r["start"] + r["length"]], "<u4").tobytes()) for r in pieces)
    used = Counter()
    for r in rows:
        used[r["sequence_id"]] += r["length"]
    total = sum(used.values())
    assert max(used.values()) <= 1024 and sum(map(op1_packing.padded_length, used.values())) <= 1.02 * total


def test_packing_a_very_long_document_is_linear():
    import time

    def seconds(n):
        packer, ids, start = op1_packing.Packer(op1_packing.Limits()), bytes(4 * n), time.process_time()
        assert sum(p.length for s in [*packer.add(1, ids), *packer.finish()] for p in s) == n
        return time.process_time() - start

    assert seconds(8_000_000) < 2.0  # 16.8 s when every cut copied the rest


def test_token_files_round_trip_and_lookup(spark, docs):
    path = folder_for(spark, "tokens-test")
    op4_token_files.write_tokens(docs, path)
    got = op4_token_files.checksums(op4_token_files.with_positions(op4_token_files.read_tokens(spark, path))).collect()
    encoder, at = Encoder(vocabulary_path(op4_token_files.VOCABULARY)), 0
    sizes = Counter((i, len(encoder.encode(t)) // 4 + 1) for i, t in _texts())
    assert Counter((r.doc_id, r.n_tokens) for r in got) == sizes
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    assert op4_token_files.lookup(spark, path, [5, 3]).count() == 3


def test_mix_meets_targets_and_reruns_agree(docs):
    rows = op10_mixing.mix(docs).collect()
    assert sorted(map(str, rows)) == sorted(map(str, op10_mixing.mix(docs.repartition(3)).collect()))
    taken, target = Counter(), {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert sum(target.values()) == pytest.approx(sum(r.size for r in rows))
    assert all(abs(taken[s] - target[s]) <= 3 * op10_mixing.LEAST_BLOCK for s in target)
    mixed = op10_mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert sum(len(WORD.findall(r.text)) for r in mixed.collect()) == sum(taken.values())


def test_mix_equals_a_plain_replay_of_its_schedule(spark, docs):
    """Targets by hand, and every document's words from the blocks in slot order; prefixes keep the weights."""
    rows = op10_mixing.mix(docs).collect()
    total = sum(r.size for r in rows)
    sizes = Counter()
    for r in rows:
        sizes[r.source] += r.size
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight, target, left, open_ = {s: i % 3 + 1 for i, s in enumerate(order)}, {}, total, set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in full:
            target[s], left = 3 * sizes[s], left - 3 * sizes[s]
        open_ -= full
    assert all(r.target == pytest.approx(target[r.source]) for r in rows)
    blocks = sorted(map(tuple, op10_mixing.mixed_blocks(docs).collect()), key=str)
    assert blocks == sorted(map(tuple, op10_mixing.mixed_blocks(docs.repartition(7)).collect()), key=str)
    replay, by_slot = Counter(), defaultdict(list)
    for slot, source, doc, position, begin, words in blocks:
        replay[source, doc, position] += words
        by_slot[slot].append((source, position, begin, words))
    assert Counter((s, d, n) for (s, d, _), n in replay.items()) == Counter((r.source, r.doc_id, r.taken) for r in rows if r.taken)
    so_far, done = Counter(), 0
    for no, slot in enumerate(sorted(by_slot)):
        sources = {s for s, *_ in by_slot[slot]}
        assert len(sources) == 1 and sum(w for *_, w in by_slot[slot]) <= op10_mixing.LEAST_BLOCK
        so_far[sources.pop()] += sum(w for *_, w in by_slot[slot])
        done += sum(w for *_, w in by_slot[slot])
        if no > len(by_slot) // 3:  # by then every source has about its share
            assert all(abs(so_far[s] / done - target[s] / total) < 0.15 for s in order)


def test_mixed_documents_come_in_schedule_order(spark):
    rows = [(i, f"{chr(97 + i % 3)}{i} " * 40, f"s{i % 3}") for i in range(90)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    slots = {r.doc_id: r.slots for r in op10_mixing.mix(frame).collect()}
    got = op10_mixing.mixed_documents(frame).withColumn("part", F.spark_partition_id()).collect()
    place = [[r.doc_id for r in got if r.part == part] for part in sorted({r.part for r in got})]
    seen, order = Counter(), []
    for d in (d for docs_ in place for d in docs_):
        order.append(slots[d][min(seen[d], len(slots[d]) - 1)])  # its copies stand at the uses of its first block
        seen[d] += 1
    assert order == sorted(order) and max(seen.values()) <= 3 and len(place) > 1
    mixed = [d % 3 for docs_ in place for d in docs_]
    assert all(len(set(mixed[k:k + 12])) > 1 for k in range(0, len(mixed) - 12))  # sources alternate


def test_language_forward_pass_sums_all_segmentations(spark):
    rows = [(i, t, l) for i, (t, l) in enumerate([("the house and the tree of it", "en"), ("das haus und der baum ist da", "de")] * 30)]
    edge = [(900, None, None), (901, "", "en"), (902, "12 !!", "de"), (903, "haus " * 20_000, None), (None, "the tree", None)]
    frame = spark.createDataFrame(rows + edge, "doc_id long, text string, lang string")
    model = op6_language.fit(frame)
    own, word = op6_language.pieces(model.path), "▁treeé日"
    forward = [1.0] + [0.0] * len(word)
    for b in range(1, len(word) + 1):
        for a in range(b):
            piece = own.index.get(word[a:b], op6_language.UNKNOWN if b == a + 1 else None)
            if piece is not None:
                forward[b] += forward[a] * model.probabilities[piece, 0]
    assert own.log_likelihoods([word], model.probabilities)[0, 0] == pytest.approx(np.log(forward[-1]))
    got = {r.doc_id: r for r in op6_language.identify(frame).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows)
    assert [got[i].lang_pred for i in (900, 901, 902, 903, None)] == ["und", "und", "und", "de", "en"]
    assert all(0 <= r.score <= 1 for r in got.values())
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got.values())


def test_long_runs_of_unseen_characters_keep_the_language():
    own = op6_language.pieces(op6_language.vocabulary_path(op6_language.VOCABULARY))
    counts = np.full((own.nothing + 1, 2), op6_language.PRIOR_COUNT)
    for no, words in enumerate((["▁das", "▁haus"], ["▁the", "▁house"])):
        for word in words:
            counts[own.index.get(word, own.index["▁"]), no] += 4e5
    counts[own.nothing] = 0
    path = op6_language.vocabulary_path(op6_language.VOCABULARY)
    model = op6_language.Model(path, ("de", "en"), np.log([0.5, 0.5]), counts / counts.sum(axis=0))
    for run in ("鱻" * 48, "╬" * 120):
        (lang, score), = op6_language.Scorer(model).score([f"the house the {run} the house"])
        assert lang == "en" and 0.5 < score <= 1
        expected = own.expected([run[:48]], np.ones(1), model.probabilities[:, 0])
        assert np.isfinite(expected).all() and 1 <= expected.sum() <= 48


def test_licence_rules_prefer_the_longest_sequence(spark):
    header = ('/*\n * Licensed under the Apache License, Version 2.0 (the "License");\n * you may not use this file except in '
              "compliance with the License.\n * You may obtain a copy of the License at\n *\n *  http://www.apache.org/licenses/"
              'LICENSE-2.0\n *\n * Unless required by applicable law or agreed to in writing, software\n * distributed under the '
              'License is distributed on an "AS IS" BASIS,\n * WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or '
              "implied.\n */")
    rows = [(1, header), (2, None), (3, ""), (None, "All rights reserved."),
            (5, "x y\nReleased under the MIT License.\nz. Licensed under CC BY-NC 4.0. Foo.")]
    got = op9_licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.rule) for r in got) == Counter([
        (1, "apache_2_header"), (None, "all_rights"), (5, "mit_notice"), (5, "cc_by_nc_4_notice")])


# Statements and the licences a reader finds in them, written by hand.
STATEMENTS = [
    ("SPDX-License-Identifier: MIT", "MIT"), ("// SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
    ("# SPDX-License-Identifier: GPL-2.0-only", "GPL-2.0-only"), ("/* SPDX-License-Identifier: GPL-2.0 */", "GPL-2.0-only"),
    ("SPDX-License-Identifier: GPL-2.0+", "GPL-2.0-or-later"), ("SPDX-License-Identifier: GPL-3.0-or-later", "GPL-3.0-or-later"),
    ("SPDX-License-Identifier: LGPL-2.1-or-later", "LGPL-2.1-or-later"), ("SPDX-License-Identifier: LGPL-3.0", "LGPL-3.0-only"),
    ("SPDX-License-Identifier: AGPL-3.0-only", "AGPL-3.0-only"), ("SPDX-License-Identifier: MPL-2.0", "MPL-2.0"),
    ("SPDX-License-Identifier: EPL-2.0", "EPL-2.0"), ("SPDX-License-Identifier: ISC", "ISC"),
    ("SPDX-License-Identifier: Unlicense", "Unlicense"), ("SPDX-License-Identifier: BSD-3-Clause", "BSD-3-Clause"),
    ("SPDX-License-Identifier: BSD-2-Clause", "BSD-2-Clause"), ("SPDX-License-Identifier: Zlib", "Zlib"),
    ("SPDX-License-Identifier: BSL-1.0", "BSL-1.0"), ("SPDX-License-Identifier: CC0-1.0", "CC0-1.0"),
    ("SPDX-License-Identifier: MIT OR Apache-2.0", "Apache-2.0,MIT"),
    ("SPDX-License-Identifier: (MIT OR Apache-2.0)", "Apache-2.0,MIT"),
    ("SPDX-License-Identifier: MIT AND BSD-3-Clause AND ISC", "BSD-3-Clause,ISC,MIT"),
    ("int x;\nSPDX-License-Identifier: MIT\nint y;", "MIT"), ("SPDX-License-Identifier: Unknown-1.0", ""),
    ("Licensed under the MIT License.", "MIT"), ("Licensed under the MIT license", "MIT"), ("Licensed under MIT.", "MIT"),
    ("Released under the Apache License 2.0.", "Apache-2.0"), ("Licensed under Apache 2.0.", "Apache-2.0"),
    ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"), ("This project is licensed under the Apache 2.0 License.", "Apache-2.0"),
    ("This project is licensed under the ISC License.", "ISC"), ("Released under the ISC license.", "ISC"),
    ("Distributed under the BSD 3-Clause License.", "BSD-3-Clause"), ("Licensed under the New BSD License.", "BSD-3-Clause"),
    ("This software is released under a BSD-style license.", "BSD-3-Clause"), ("Licensed under the Simplified BSD License.", "BSD-2-Clause"),
    ("This library is licensed under the 2-Clause BSD License.", "BSD-2-Clause"),
    ("Licensed under the GPLv3.", "GPL-3.0-only"), ("Licensed under GPL v3.", "GPL-3.0-only"), ("Licensed under the GPLv3+.", "GPL-3.0-or-later"),
    ("This program is licensed under the GNU General Public License v2.", "GPL-2.0-only"), ("Licensed under GPLv2+.", "GPL-2.0-or-later"),
    ("Licensed under the GNU General Public License version 2 or later.", "GPL-2.0-or-later"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0-only"),
    ("Licensed under the GNU Lesser General Public License v2.1.", "LGPL-2.1-only"), ("Licensed under LGPL-2.1+.", "LGPL-2.1-or-later"),
    ("Distributed under the GNU Lesser General Public License, version 3.", "LGPL-3.0-only"),
    ("This software is licensed under the GNU Affero General Public License v3.", "AGPL-3.0-only"), ("Licensed under AGPLv3.", "AGPL-3.0-only"),
    ("Licensed under the Mozilla Public License 2.0.", "MPL-2.0"), ("This file is licensed under the MPL 2.0.", "MPL-2.0"),
    ("This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed "
     "with this\n * file, You can obtain one at https://mozilla.org/MPL/2.0/.", "MPL-2.0"),
    ("Available under the Eclipse Public License 2.0.", "EPL-2.0"), ("Licensed under the Eclipse Public License v1.0.", "EPL-1.0"),
    ("This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy.", "Unlicense"),
    ("Released under the Unlicense.", "Unlicense"), ("Licensed under the Boost Software License, Version 1.0.", "BSL-1.0"),
    ("Licensed under the zlib License.", "Zlib"), ("Licensed under CC BY 4.0.", "CC-BY-4.0"), ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"),
    ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", "CC-BY-ND-4.0"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "CC-BY-NC-4.0"),
    ("Released under CC0 1.0.", "CC0-1.0"), ("All rights reserved.", "LicenseRef-proprietary"),
    ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n", "GPL-3.0-only"),
    ("                    GNU AFFERO GENERAL PUBLIC LICENSE\n                       Version 3, 19 November 2007\n", "AGPL-3.0-only"),
    ("This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\n"
     "License as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.", "LGPL-2.1-or-later"),
    ("This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU Affero General Public License as "
     "published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.", "AGPL-3.0-or-later"),
    ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that "
     "the above\ncopyright notice and this permission notice appear in all copies.", "ISC"),
    ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
     "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "GPL-2.0-or-later"),
    ("The licence of this text is discussed elsewhere.", ""), ("He works under the new management.", ""), ("Version 2+ is out.", ""),
]


def test_statements_labelled_by_hand(spark):
    assert len(STATEMENTS) >= 60
    docs = spark.createDataFrame(list(enumerate(t for t, _ in STATEMENTS)), "doc_id long, text string").withColumns(
        {"normal": F.lit("mit"), "sentence": F.lit(1), "place": F.lit(2)})
    got = defaultdict(set)
    for r in op9_licences.scan(docs).collect():
        got[r.doc_id].add(r.licence)
    wrong = [(t, sorted(got[i]), want) for i, (t, want) in enumerate(STATEMENTS) if ",".join(sorted(got[i])) != want]
    assert not wrong


def test_empty_tables(docs):
    none = docs.where(F.lit(False))
    for frame in (op1_packing.pack(none), op5_substrings.remove_repeats(none), op6_language.identify(none),
                  op8_simhash.near_duplicates(none), op9_licences.scan(none), op10_mixing.mix(none)):
        assert frame.count() == 0


def test_a_worker_holds_one_large_helper_at_a_time():
    """An encoder's pieces don't stay in a worker beside the next operator's tables; another use of the same one does."""
    from strataline.llm import op6_language, shared, tokens

    first = tokens.encoder(tokens.vocabulary_path("word_bpe_49k.json"))
    assert tokens.encoder(tokens.vocabulary_path("word_bpe_49k.json")) is first
    assert first.encode("Some words") == tokens.Encoder(tokens.vocabulary_path("word_bpe_49k.json"), added_as_text=False).encode("Some words")
    op6_language.pieces(op6_language.vocabulary_path(op6_language.VOCABULARY))
    assert len(shared._HELD) == 1 and first not in shared._HELD.values()
