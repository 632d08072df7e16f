"""Plain statements of the rules, and small fixtures."""

import re

import numpy as np

from corpuscle.functions.text import HEADER_FIELDS, SIGNATURE_LINES

DIM = 16


def expected_body(raw: str) -> list[str]:
    def header(line: str) -> bool:
        known = line.partition(":")[0].strip().lower() in HEADER_FIELDS
        return known or re.match(r"[A-Za-z0-9-]+\s*:", line) is not None

    lines = raw.splitlines()
    stop = next((i for i, line in enumerate(lines) if not line.strip() or not header(line)), None)
    if stop is None:
        return []
    return lines[stop if lines[stop].strip() else stop + 1 :]


def expected_unquoted(lines: list[str]) -> list[str]:
    cut = [i for i, line in enumerate(lines) if line.strip() in SIGNATURE_LINES]
    return [line for line in lines[: min(cut, default=len(lines))] if line.strip()[:1] != ">"]


def expected_clean(raw: str) -> str:
    joined = "\n".join(expected_unquoted(expected_body(raw)))
    return re.sub("\n\n\n+", "\n\n", joined).strip()


def unit(seed: int, dim: int = DIM) -> np.ndarray:
    v = np.random.default_rng(seed).random(dim)
    return v / np.linalg.norm(v)


def unit_rows(n: int, seed: int, dim: int = DIM) -> np.ndarray:
    v = np.random.default_rng(seed).normal(size=(n, dim)).astype(np.float32).astype(np.float64)
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32).astype(np.float64)


def vector_rows(spark, matrix: np.ndarray, key: str = "vec_id", column: str = "embedding", first: int = 0):
    return spark.createDataFrame(
        [(first + i, [float(x) for x in row]) for i, row in enumerate(matrix)],
        f"{key} bigint, {column} array<float>",
    )


def log_rows(spark, rows):
    """(seq, op, query, vector, threshold, n_results)"""
    return spark.createDataFrame(
        [
            (seq, op, query, None if v is None else [float(x) for x in v], threshold, n)
            for seq, op, query, v, threshold, n in rows
        ],
        "seq bigint, op string, query string, vector array<float>, threshold double, n_results int",
    )


def serial_replay(rows, centres: np.ndarray, threshold: float, digits: int = 12):
    """The log played one request at a time: {seq: (hit, source_seq, matched, era)}."""
    entries: dict[str, dict] = {}
    era, out = 0, {}
    for seq, op, query, v, own, _ in sorted(rows, key=lambda r: r[0]):
        if op == "flush":
            entries, era = {}, era + 1
            continue
        v = np.asarray(v, dtype=np.float32).astype(np.float64)
        bucket = int(np.argmin(np.linalg.norm(centres - v, axis=1)))
        best, match = -1.0, None
        for text, entry in entries.items():
            score = round(float(v @ entry["vector"]), digits)
            if entry["bucket"] == bucket and score > best:
                best, match = score, text
        if match is not None and best >= (threshold if own is None else own):
            out[seq] = (True, entries[match]["seq"], match, era)
        else:
            entries[query] = {"vector": v, "bucket": bucket, "seq": seq}
            out[seq] = (False, seq, None, era)
    return out
