"""A gated recurrent network with a class-factored softmax, in numpy: forward, backward, updates.

Texts run side by side in lanes, one after another in each lane, and the state is set to zero
where a text starts. A lane is read in windows; the state goes on from one window to the next,
gradients stop at a window's start (truncated backpropagation).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

END = 0  # ends a text, and is the input before its first word
NO_WORD = -1e9  # logit of a place of a class that holds no word
FIRST_SQUARES = 1e-6
BLOCK = 32
LEARNED_PLACES, SCORED_PLACES = 2048, 8192
TABLE_ROWS = 1024
NAMES = ("embed", "enter", "enter_bias", "turn", "classes", "class_bias", "words", "word_bias")


@dataclass(frozen=True)
class Layout:
    """Items a text consists of: the end, words in classes of ``class_words``, and one item per rare class."""

    n_words: int
    class_words: int
    n_rare: int

    @property
    def n_word_classes(self) -> int:
        return -(-self.n_words // self.class_words)

    @property
    def n_classes(self) -> int:
        return 1 + self.n_word_classes + self.n_rare

    @property
    def n_items(self) -> int:
        return 1 + self.n_words + self.n_rare

    def class_of(self) -> np.ndarray:
        words = 1 + np.arange(self.n_words) // self.class_words
        return np.concatenate([[0], words, 1 + self.n_word_classes + np.arange(self.n_rare)]).astype(np.int64)

    def padded(self) -> tuple[int, int]:
        """Word classes and places in each; the last class may have places without a word."""
        return max(self.n_word_classes, 1), self.class_words


class Network:
    """Weights by name; ``squares`` are the sums of squared gradients that scale the steps (Adagrad)."""

    rate = 0.1

    def __init__(self, layout: Layout, hidden: int, width: int, seed: int, counts: np.ndarray):
        """Starts at the frequencies ``counts`` of the items, which the biases hold, with small random weights."""
        draw = np.random.default_rng(seed)
        self.layout, self.hidden, self.width = layout, hidden, width
        self.class_of = layout.class_of()
        shapes = {
            "embed": (layout.n_items, width), "enter": (width, 3 * hidden), "enter_bias": (3 * hidden,),
            "turn": (hidden, 3 * hidden), "classes": (hidden, layout.n_classes), "class_bias": (layout.n_classes,),
            "words": (*layout.padded(), hidden), "word_bias": layout.padded(),
        }
        scale = {"embed": 0.3, "enter": width**-0.5, "turn": hidden**-0.5}
        self.weights = {n: (draw.standard_normal(shapes[n]) * scale.get(n, 0.0)).astype(np.float32) for n in NAMES}
        per_class = np.bincount(self.class_of, counts, layout.n_classes) + 0.1
        self.weights["class_bias"][:] = np.log(per_class / per_class.sum())
        held = np.zeros(layout.padded())
        held.ravel()[: layout.n_words] = counts[1 : 1 + layout.n_words] + 0.1
        with np.errstate(divide="ignore"):
            logs = np.log(held / np.maximum(held.sum(axis=1, keepdims=True), 0.1))
        self.weights["word_bias"][:] = np.maximum(logs, NO_WORD)
        self.squares = {n: np.full(shapes[n], FIRST_SQUARES, np.float32) for n in NAMES}

    def flat(self) -> np.ndarray:
        return np.concatenate([x[n].ravel() for x in (self.weights, self.squares) for n in NAMES])

    def load(self, values: np.ndarray) -> Network:
        at = 0
        for table in (self.weights, self.squares):
            for n in NAMES:
                size = table[n].size
                table[n] = values[at : at + size].reshape(table[n].shape).astype(np.float32)
                at += size
        return self

    def _by_gate(self, name: str) -> np.ndarray:
        """A weight table as three tables, one per gate, so that every part of a step lies together."""
        table = self.weights[name].reshape(-1, 3, self.hidden)
        return np.ascontiguousarray(table.transpose(1, 0, 2))

    def forward(self, items: np.ndarray, goes_on: np.ndarray, state: np.ndarray, keep: bool = True) -> dict[str, np.ndarray]:
        """States after every step of a window (steps x lanes), and the parts that going back needs.

        Unless ``keep``, these parts are written over at each step, which stays in the cache.
        """
        enter, bias, turn = self._by_gate("enter"), self.weights["enter_bias"].reshape(3, 1, self.hidden), self._by_gate("turn")
        # the logistic function of x is that of tanh of x / 2; the two gates are halved here, once a window
        half = np.array([0.5, 0.5, 1.0], np.float32).reshape(3, 1, 1)
        enter, bias, turn = enter * half, bias * half, turn * half
        if items.size > len(self.weights["embed"]):
            entering = (self.weights["embed"] @ enter + bias)[:, items]
        else:
            entering = (self.weights["embed"][items.ravel()] @ enter + bias).reshape(3, *items.shape, self.hidden)
        shape = (len(items) if keep else 1, items.shape[1], self.hidden)
        out = {n: np.empty(shape, np.float32) for n in ("before", "fresh")}
        out["states"] = np.empty((*items.shape, self.hidden), np.float32)
        # the three gates are hold, reset and the fresh state
        out["turned"], out["gates"] = np.empty((3, *shape), np.float32), np.empty((2, *shape), np.float32)
        for t in range(len(items)):
            held = t if keep else 0
            before, fresh, after = out["before"][held], out["fresh"][held], out["states"][t]
            turned, gates = out["turned"][:, held], out["gates"][:, held]
            np.multiply(state, goes_on[t][:, None], out=before)
            np.matmul(before, turn, out=turned)
            np.add(entering[:2, t], turned[:2], out=gates)
            np.tanh(gates, out=gates)
            gates += 1.0
            gates *= 0.5
            np.multiply(gates[1], turned[2], out=fresh)
            fresh += entering[2, t]
            np.tanh(fresh, out=fresh)
            np.subtract(before, fresh, out=after)
            after *= gates[0]
            after += fresh
            state = after
        return out

    def backward(self, items: np.ndarray, goes_on: np.ndarray, held: dict[str, np.ndarray], d_states: np.ndarray) -> None:
        """Step down the gradients of the recurrent part, given those of the states."""
        h = self.hidden
        (hold, reset), fresh, before = held["gates"], held["fresh"], held["before"]
        # what a state's gradient is multiplied by to give those of what the state turned into
        let_go = 1.0 - hold
        to_fresh = fresh * fresh
        np.subtract(1.0, to_fresh, out=to_fresh)
        to_fresh *= let_go
        to_turned = np.empty_like(held["turned"])
        np.subtract(before, fresh, out=to_turned[0])
        to_turned[0] *= hold
        to_turned[0] *= let_go
        np.multiply(to_fresh, reset, out=to_turned[2])
        np.subtract(1.0, reset, out=let_go)
        np.multiply(to_turned[2], let_go, out=to_turned[1])
        to_turned[1] *= held["turned"][2]
        d = d_states
        back = np.ascontiguousarray(self._by_gate("turn").transpose(0, 2, 1))
        for t in range(len(items) - 1, -1, -1):
            turned = to_turned[:, t]
            turned *= d[t]
            if t:
                earlier = np.matmul(turned, back)
                later = earlier[0]
                later += earlier[1]
                later += earlier[2]
                later += d[t] * hold[t]
                later *= goes_on[t][:, None]
                d[t - 1] += later
        to_fresh *= d
        flat = before.reshape(-1, h).T
        self.step("turn", np.concatenate([flat @ part.reshape(-1, h) for part in to_turned], axis=1))
        # the gradients of what entered are those of what turned, but for the fresh state's
        parts = [to_turned[0].reshape(-1, h), to_turned[1].reshape(-1, h), to_fresh.reshape(-1, h)]
        used = items.ravel()
        embedded = self.weights["embed"][used].T
        enter = self._by_gate("enter")
        d_embedded = sum(part @ table.T for part, table in zip(parts, enter, strict=True))
        self.step("enter", np.concatenate([embedded @ part for part in parts], axis=1))
        self.step("enter_bias", np.concatenate([_ones(len(part)) @ part for part in parts]))
        used = used.astype(np.intp)
        rows = np.flatnonzero(np.bincount(used, minlength=self.layout.n_items))
        sums = [np.bincount(used, column, self.layout.n_items)[rows] for column in np.ascontiguousarray(d_embedded.T)]
        self.step("embed", np.stack(sums, axis=1).astype(np.float32), rows)

    def step(self, name: str, gradient: np.ndarray, rows: np.ndarray | slice = slice(None)) -> None:
        root = gradient * gradient
        if isinstance(rows, slice) or len(rows) == len(self.squares[name]):
            squares, weights = self.squares[name], self.weights[name]
            squares += root
            np.sqrt(squares, out=root)
            np.divide(gradient, root, out=root)
            root *= self.rate
            weights -= root
            return
        root += self.squares[name][rows]
        self.squares[name][rows] = root
        np.sqrt(root, out=root)
        np.divide(gradient, root, out=root)
        root *= self.rate
        self.weights[name][rows] -= root

    def outputs(self, states: np.ndarray, targets: np.ndarray, learn: bool) -> tuple[np.ndarray, np.ndarray | None]:
        """Log probabilities of ``targets`` (for a rare item: of its class), and the states' gradients if ``learn``."""
        w = self.weights
        share = np.float32(1.0 / max(len(targets), 1))
        goal = self.class_of[targets]
        reach = _reach(w["classes"].T, w["class_bias"])
        out = np.empty(len(targets))
        d_states = np.empty_like(states) if learn else None
        d_classes, d_bias = np.zeros_like(w["classes"]), np.zeros_like(w["class_bias"])
        # some rows at a time, so that their table stays in the cache
        for rows in (slice(i, i + TABLE_ROWS) for i in range(0, len(targets), TABLE_ROWS)):
            held, place = states[rows], goal[rows]
            every = np.arange(len(place))
            table = held @ w["classes"]
            table += w["class_bias"]
            out[rows], sums = _softmax(table, every, place, reach)
            if learn:
                table *= (share / sums)[:, None]
                table[every, place] -= share
                np.matmul(table, w["classes"].T, out=d_states[rows])
                d_classes += held.T @ table
                d_bias += _ones(len(table)) @ table
        in_words = np.flatnonzero((goal > 0) & (goal <= self.layout.n_word_classes))
        if len(in_words):
            self._word_outputs(states, targets, goal, in_words, out, d_states, share)
        if learn:
            self.step("classes", d_classes)
            self.step("class_bias", d_bias)
        return out, d_states

    def _word_outputs(self, states, targets, goal, in_words, out, d_states, share) -> None:
        """Add the log probabilities inside word classes, in blocks of ``BLOCK`` targets of one class."""
        w, size = self.weights, self.layout.class_words
        order = in_words[np.argsort(goal[in_words], kind="stable")]
        kind = goal[order] - 1
        counts = np.bincount(kind, minlength=self.layout.n_word_classes)
        blocks = -(-counts // BLOCK)
        first_block = np.cumsum(blocks) - blocks
        rank = np.arange(len(order)) - np.repeat(np.cumsum(counts) - counts, counts)
        rows = first_block[kind] * BLOCK + rank
        block_kind = np.repeat(np.arange(len(blocks)), blocks)
        held = np.zeros((len(block_kind) * BLOCK, self.hidden), np.float32)
        held[rows] = states[order]
        held = held.reshape(-1, BLOCK, self.hidden)
        weights = w["words"][block_kind]
        table = held @ weights.transpose(0, 2, 1)
        table += w["word_bias"][block_kind][:, None, :]
        flat = table.reshape(-1, size)
        place = targets[order] - 1 - kind * size
        logs, sums = _softmax(flat, rows, place, _reach(w["words"], w["word_bias"]))
        out[order] += logs
        if d_states is None:
            return
        factor = np.zeros(len(flat), np.float32)
        factor[rows] = share / sums[rows]
        flat *= factor[:, None]
        flat[rows, place] -= share
        d_states[order] += (table @ weights).reshape(-1, self.hidden)[rows]
        used = np.flatnonzero(blocks)
        of_kind = (used[:, None] == block_kind).astype(np.float32)
        d_words = of_kind @ (table.transpose(0, 2, 1) @ held).reshape(len(block_kind), -1)
        self.step("word_bias", of_kind @ (_ones(BLOCK) @ table), used)
        self.step("words", d_words.reshape(len(used), size, self.hidden), used)

    def learn(self, lanes: Lanes, window: int) -> None:
        """One pass over the texts, a step of all weights per window.

        Where few lanes run, windows are longer, so that a step sees about as many words.
        """
        for part in lanes.windows(window, self.hidden, LEARNED_PLACES):
            held = self.forward(part.items, part.goes_on, part.state)
            part.end_state = held["states"][-1]
            if part.targets.min() >= 0:
                # every place holds a word
                flat = held["states"].reshape(-1, self.hidden)
                d_states = self.outputs(flat, part.targets.ravel(), learn=True)[1].reshape(held["states"].shape)
            else:
                used = part.targets >= 0
                d_states = np.zeros_like(held["states"])
                d_states[used] = self.outputs(held["states"][used], part.targets[used], learn=True)[1]
            self.backward(part.items, part.goes_on, held, d_states)

    def score(self, lanes: Lanes, window: int) -> np.ndarray:
        """Log probability (natural) of each text; the windows are longer where few lanes run."""
        total = np.zeros(lanes.n_texts)
        for part in lanes.windows(window, self.hidden, SCORED_PLACES):
            states = self.forward(part.items, part.goes_on, part.state, keep=False)["states"]
            part.end_state = states[-1]
            if part.targets.min() >= 0:
                logs, _ = self.outputs(states.reshape(-1, self.hidden), part.targets.ravel(), learn=False)
                total += np.bincount(part.texts.ravel(), logs, lanes.n_texts)
            else:
                used = part.targets >= 0
                logs, _ = self.outputs(states[used], part.targets[used], learn=False)
                total += np.bincount(part.texts[used], logs, lanes.n_texts)
        return total


def _reach(weights: np.ndarray, bias: np.ndarray) -> float:
    """How far logits can be from zero in either direction that matters, as states lie in [-1, 1]."""
    sums = np.abs(weights).reshape(-1, weights.shape[-1]) @ _ones(weights.shape[-1])
    return float(sums.max() + max(bias.max(), -bias.max(axis=-1).min(), 0.0))


def _ones(n: int) -> np.ndarray:
    """A product with ones adds up the rows or columns of a table faster than a sum along an axis."""
    return np.ones(n, np.float32)


def _softmax(table: np.ndarray, rows: np.ndarray, goals: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Turns logits into their exponentials; gives the log probabilities of ``goals`` in ``rows``, and all rows' sums."""
    if reach > 60:
        # else no exponential overflows and no sum vanishes
        table -= table.max(axis=1, keepdims=True)
    at_goal = table[rows, goals].astype(np.float64)
    np.exp(table, out=table)
    sums = table @ _ones(table.shape[1])
    return at_goal - np.log(sums[rows].astype(np.float64)), sums


@dataclass
class Window:
    items: np.ndarray
    targets: np.ndarray
    goes_on: np.ndarray
    texts: np.ndarray
    state: np.ndarray
    end_state: np.ndarray | None = None


class Lanes:
    """Texts dealt to lanes, longest first to the shortest lane; each is its words and the end.

    There are at most ``n_lanes``, and no more than the longest text leaves work for, so that
    the tables hold about as many places as there are words.
    """

    def __init__(self, words: np.ndarray, sizes: np.ndarray, n_lanes: int):
        self.n_texts = len(sizes)
        lengths = sizes + 1
        total, longest = int(lengths.sum()), int(lengths.max(initial=1))
        n_lanes = max(1, min(n_lanes, -(-total // longest), self.n_texts))
        loads = [(0, lane) for lane in range(n_lanes)]
        lane_of, start_of = np.zeros(self.n_texts, np.int64), np.zeros(self.n_texts, np.int64)
        for text in np.argsort(-lengths, kind="stable").tolist():
            load, lane = loads[0]
            lane_of[text], start_of[text] = lane, load
            heapq.heapreplace(loads, (load + int(lengths[text]), lane))
        totals = np.zeros(n_lanes, np.int64)
        for load, lane in loads:
            totals[lane] = load
        # longest lanes first: the lanes still running are always the first ones
        order = np.argsort(-totals, kind="stable")
        self.totals, rank = totals[order], np.empty(n_lanes, np.int64)
        rank[order] = np.arange(n_lanes)
        lane_of = rank[lane_of]

        first = np.cumsum(lengths) - lengths
        # the place of every word in a table of steps x lanes, row by row
        place = np.arange(total)
        place *= n_lanes
        place += np.repeat(n_lanes * (start_of - first) + lane_of, lengths)
        is_last = np.zeros(total, bool)
        is_last[first + sizes] = True
        shape = (int(self.totals[0]) if self.n_texts else 0, n_lanes)
        goals = np.full(total, END, np.int32)
        goals[~is_last] = words
        inputs = np.empty(total, np.int32)
        inputs[1:] = goals[:-1]
        inputs[first] = END
        self.items, self.targets = np.full(shape, END, np.int32), np.full(shape, -1, np.int32)
        self.goes_on, self.texts = np.ones(shape, np.float32), np.zeros(shape, np.int32)
        self.items.ravel()[place] = inputs
        self.targets.ravel()[place] = goals
        self.texts.ravel()[place] = np.repeat(np.arange(self.n_texts, dtype=np.int32), lengths)
        self.goes_on.ravel()[place[first]] = 0.0

    def windows(self, size: int, hidden: int, places: int = 0) -> Iterator[Window]:
        """Windows of ``size`` steps, or more where the running lanes would fill fewer than ``places`` places."""
        state = np.zeros((len(self.totals), hidden), np.float32)
        at = 0
        while at < len(self.items):
            running = int(np.searchsorted(-self.totals, -at, side="left"))
            end = at + max(size, places // running)
            cut = (slice(at, end), slice(0, running))
            part = Window(self.items[cut], self.targets[cut], self.goes_on[cut], self.texts[cut], state[:running])
            yield part
            state, at = part.end_state, end
