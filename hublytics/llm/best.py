"""The first k of many rows for each of many askers, tile by tile."""

from __future__ import annotations

import numpy as np

NONE = np.iinfo(np.int64).min
LAST = np.iinfo(np.int64).max


class Best:
    """For each of ``n`` askers the ``k`` first rows by score descending, then
    id ascending, of all that were offered. ``kth_score`` and ``kth_id`` are
    an asker's last place (NONE, LAST while it holds fewer than k)."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.who = self.score = self.id = np.zeros(0, np.int64)
        self.kth_score, self.kth_id = np.full(n, NONE), np.full(n, LAST)

    def offer(self, who: np.ndarray, score: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        """Rows ``ids`` with ``score`` (askers x rows), where ``allowed``."""
        last_score, last_id = self.kth_score[who, None], self.kth_id[who, None]
        better = allowed & ((score > last_score) | ((score == last_score) & (ids < last_id)))
        if score.shape[1] > 4 * self.k and better.any():
            # a tile's k-th score bounds what it can add; equal scores all stay
            masked = np.where(better, score, NONE)
            better &= masked >= np.partition(masked, -self.k, axis=1)[:, -self.k, None]
        asker, row = np.nonzero(better)
        if not len(asker):
            return
        asker_all = np.concatenate([self.who, who[asker]])
        score_all = np.concatenate([self.score, score[asker, row]])
        id_all = np.concatenate([self.id, ids[row]])
        order = np.lexsort((id_all, -score_all, asker_all))
        asker_all, score_all, id_all = asker_all[order], score_all[order], id_all[order]
        first = np.searchsorted(asker_all, asker_all)
        place = np.arange(len(asker_all)) - first
        held = place < self.k
        self.who, self.score, self.id = asker_all[held], score_all[held], id_all[held]
        full = place[held] == self.k - 1
        self.kth_score[self.who[full]], self.kth_id[self.who[full]] = self.score[full], self.id[full]
