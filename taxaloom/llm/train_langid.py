"""Train the network of `langid`: python -m taxaloom.llm.train_langid TABLES_DIR.

Labelled text: the sentences of `species_records.descriptions` under their locale and of
`documents` under their lang, at most MOST of a language in hash order. What `quality` calls a table
or junk gives, where it is no closed sentence, the windows in no language, and so do references and
menus in lists (other lists count as text); generated codes are added. Labels are noisy, so
training runs twice: sentences that the first network firmly gives another language are left out
of the second. Half of each epoch's sentences are cut to a run of their words, from two on, so that
short segments are known too. A tenth is held out, and its accuracy is printed and stored.
"""

from __future__ import annotations

import json
import re
import sys
import zlib

import numpy as np

from taxaloom.llm import langid, quality
from taxaloom.llm.common import MODELS, descriptions
from taxaloom.session import get_spark, table

#: Sentences of each language at most.
MOST = 4_000
NONE = "none"
CLASSES = (*langid.LANGS, NONE)
#: Letters of generated codes.
ALPHABETS = ("abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxyz0123456789+/", "0123456789abcdef", "bcdfghjklmnpqrstvwxz;")
CLOSED = re.compile(r"[.!?。！？][\"”»’)\]\d\[]*\s*$")
EMB, FILTERS, EPOCHS, BATCH, RATE = 12, 24, 9, 64, 3e-3


def fit(m: list[bytes], y: np.ndarray, seed: int = 1) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    p = {"emb": rng.normal(0, 0.3, (256, EMB)), "v": rng.normal(0, 0.1, (len(langid.WIDTHS) * FILTERS, len(langid.LANGS) + 1)), "c": np.zeros(len(langid.LANGS) + 1)}
    for w in langid.WIDTHS:
        p[f"w{w}"] = rng.normal(0, 1 / np.sqrt(w * EMB), (w, EMB, FILTERS))
        p[f"b{w}"] = np.zeros(FILTERS)
    p = {k: x.astype(np.float32) for k, x in p.items()}
    p["emb"][0] = 0
    mean, var, step = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}, 0
    total = EPOCHS * (len(m) // BATCH)
    for _ in range(EPOCHS):
        order = rng.permutation(len(m))
        for i in range(0, len(order) - BATCH + 1, BATCH):
            idx = order[i : i + BATCH]
            x = langid.to_matrix([_crop(m[j], rng)[: langid.WINDOW] for j in idx])
            x = x[:, : max(8, int((x != 0).sum(1).max()) + 1)]
            e = p["emb"][x]
            h, pos = [], []
            for w in langid.WIDTHS:
                n = x.shape[1] - w + 1
                a = sum(e[:, k : k + n].reshape(-1, EMB) @ p[f"w{w}"][k] for k in range(w)).reshape(len(x), n, FILTERS)
                at = a.argmax(1)
                pos.append(at)
                h.append(np.take_along_axis(a, at[:, None], 1)[:, 0] + p[f"b{w}"])
            z = np.concatenate(h, 1)
            keep = (rng.random(z.shape) < 0.8) / 0.8
            r = np.maximum(z, 0) * keep
            q = langid.softmax(r @ p["v"] + p["c"])
            q[np.arange(len(x)), y[idx]] -= 1
            q /= len(x)
            g = {"v": r.T @ q, "c": q.sum(0), "emb": np.zeros_like(p["emb"])}
            dz = (q @ p["v"].T) * keep * (z > 0)
            rows = np.arange(len(x))[:, None]
            for b, w in enumerate(langid.WIDTHS):
                d = dz[:, b * FILTERS : (b + 1) * FILTERS]
                g[f"b{w}"] = d.sum(0)
                gw = np.empty_like(p[f"w{w}"])
                for k in range(w):
                    byte = x[rows, pos[b] + k]
                    gw[k] = np.einsum("nfe,nf->ef", p["emb"][byte], d)
                    np.add.at(g["emb"], byte, d[:, :, None] * p[f"w{w}"][k].T[None])
                g[f"w{w}"] = gw
            g["emb"][0] = 0
            step += 1
            rate = RATE * min(1, step / 100) * (1 - 0.9 * step / total)
            for k in p:
                mean[k] = 0.9 * mean[k] + 0.1 * g[k]
                var[k] = 0.999 * var[k] + 0.001 * g[k] ** 2
                p[k] -= (rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(var[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return p


def _crop(w: bytes, rng) -> bytes:
    if rng.random() < 0.5:
        return w
    words = w.split()
    if len(words) < 2:
        return w
    if len(words) < 6 and max(map(len, words)) > 24:
        k = len(w) // 3
        a = int(rng.integers(0, max(1, k)))
        return w[a : a + max(24, len(w) - k)]
    n = min(len(words), int(rng.integers(2, len(words) + 1)) if rng.random() < 0.7 else int(rng.integers(2, 5)))
    a = int(rng.integers(0, len(words) - n + 1))
    return b" ".join([b"", *words[a : a + n], b""])


def _wordless(text: str, a: int, b: int) -> bool:
    """Whether a part of a list is references (digits in its lines) or menu items (capitals alone)."""
    lines = text[text.rfind("\n", 0, a) + 1 : (text.find("\n", b) + 1 or len(text) + 1) - 1]
    words = re.findall(r"[^\W\d_]+", text[a:b])
    return sum(map(str.isdigit, lines)) >= 6 or len(words) >= 5 and all(w[0].isupper() for w in words)


def main(tables: str) -> None:
    spark = get_spark()
    assessed = quality.assess(descriptions(table(spark, tables, "species_records"))).select("locale", "text", "verdict")
    prose = assessed.where("verdict = 'prose'").selectExpr("locale", "text")
    d = prose.unionByName(table(spark, tables, "documents").selectExpr("lang as locale", "text"))
    rows = d.where("text is not null and locale is not null").distinct().selectExpr(f"{langid.label_language('locale')} as lang", "text").where("lang is not null").collect()
    seen: dict[str, str] = {}
    for r in rows:
        for _, _, clean, _ in langid.segments(r.text):
            seen.setdefault(clean, r.lang)
    for r in assessed.where("verdict <> 'prose'").selectExpr("text", "verdict", f"{langid.label_language('locale')} as lang").distinct().collect():
        for a, b, clean, _ in langid.segments(r.text):
            if _wordless(r.text, a, b) if r.verdict == "list" else not CLOSED.search(r.text[a:b]):
                seen.setdefault(clean, NONE)
            elif r.verdict == "list" and r.lang:
                seen.setdefault(clean, r.lang)
    rng = np.random.default_rng(5)
    for _ in range(MOST // 3):
        alphabet = ALPHABETS[int(rng.integers(len(ALPHABETS)))]
        seen.setdefault(" ".join("".join(alphabet[i] for i in rng.integers(0, len(alphabet), int(rng.integers(2, 13)))) for _ in range(int(rng.integers(2, 16)))), NONE)
    items = sorted(seen.items(), key=lambda x: zlib.crc32(x[0].encode()))
    left = dict.fromkeys(CLASSES, MOST)
    kept = []
    for c, lang in items:
        left[lang] -= 1
        if left[lang] >= 0:
            kept.append((c, lang))
    items = kept
    ws = [langid.windows(c)[0] for c, _ in items]
    y = np.array([CLASSES.index(lang) for _, lang in items])
    held = np.arange(len(ws)) % 10 == 0
    print(len(ws), {k: int((y == i).sum()) for i, k in enumerate(CLASSES)}, flush=True)
    first = langid.Net(fit([w for w, h in zip(ws, held) if not h], y[~held]))
    q = langid.softmax(first.scores(langid.to_matrix(ws)))
    wrong = (q.argmax(1) != y) & (q.max(1) > 0.6)
    print("left out", int(wrong.sum()), flush=True)
    use = ~held & ~wrong
    print("second", flush=True)
    p = fit([w for w, u in zip(ws, use) if u], y[use])
    got = langid.softmax(langid.Net(p).scores(langid.to_matrix(ws)))
    ok = held & ~wrong
    report = {"sentences": len(ws), "left_out": int(wrong.sum()), "held_out": int(ok.sum()), "accuracy": round(float((got[ok].argmax(1) == y[ok]).mean()), 5), "raw_accuracy": round(float((got[held].argmax(1) == y[held]).mean()), 5)}
    np.savez_compressed(MODELS / "langid.npz", **{k: x.astype(np.float16) for k, x in p.items()})
    (MODELS / "langid.json").write_text(json.dumps(report) + "\n")
    print(report)
    for i in np.flatnonzero(held & (got.argmax(1) != y))[:25]:
        print(CLASSES[y[i]], CLASSES[got[i].argmax()], round(float(got[i].max()), 3), items[i][0][:110])


if __name__ == "__main__":
    main(sys.argv[1])
