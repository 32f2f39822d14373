"""The network of :mod:`language`: forward pass, backpropagation through time, pooling.

Each direction keeps ``HIDDEN`` units; at every byte

    u = sigmoid(A[byte] + h U),  c = tanh(B[byte] + h V),  h' = h + u (c - h)

and the label of a position is a softmax over both directions' states there.
"""

from __future__ import annotations

import numpy as np

HIDDEN = 8
# Bytes per window; a text's windows follow one another, the last one is padded.
WINDOW = 128
# Windows that go through the network together; their states take 8 KB each.
TOGETHER = 1024
STEPS, BATCH, RATE = 240, 128, 0.02
# Bytes of letters: ASCII letters and all parts of non-ASCII characters.
LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])


def _run(inputs: np.ndarray, recurrent: np.ndarray, codes: np.ndarray, states: np.ndarray, backward: bool) -> None:
    """States at every step; ``codes`` is (steps, windows), ``states`` (steps, windows, HIDDEN).

    Both halves of ``inputs`` and ``recurrent`` go through one tanh: the gate's
    half is scaled by 1/2 beforehand, as sigmoid(x) = (1 + tanh(x/2)) / 2.
    """
    steps, windows = codes.shape
    h = np.zeros((windows, HIDDEN), np.float32)
    both, fed = np.empty((windows, 2 * HIDDEN), np.float32), np.empty((windows, 2 * HIDDEN), np.float32)
    gate, change = np.empty_like(h), np.empty_like(h)
    for t in range(steps - 1, -1, -1) if backward else range(steps):
        np.take(inputs, codes[t], axis=0, out=both, mode="clip")
        np.matmul(h, recurrent, out=fed)
        both += fed
        np.tanh(both, out=both)
        np.multiply(both[:, :HIDDEN], 0.5, out=gate)
        gate += 0.5
        np.subtract(both[:, HIDDEN:], h, out=change)
        change *= gate
        h += change
        states[t] = h


class Network:
    """Parameters (float32) and labels of a trained network."""

    def __init__(self, labels: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.labels = list(labels)
        self.inputs = [rng.normal(0, 0.3, (256, 2 * HIDDEN)).astype(np.float32) for _ in range(2)]
        self.recurrent = [rng.normal(0, 0.3, (HIDDEN, 2 * HIDDEN)).astype(np.float32) for _ in range(2)]
        self.out = rng.normal(0, 0.3, (2 * HIDDEN, len(labels))).astype(np.float32)
        self.bias = np.zeros(len(labels), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [*self.inputs, *self.recurrent, self.out, self.bias]

    def states(self, codes: np.ndarray) -> np.ndarray:
        """(steps, windows, 2 * HIDDEN) of both directions."""
        both = np.empty((2, *codes.shape, HIDDEN), np.float32)
        for d in range(2):
            _run(self.inputs[d], self.recurrent[d], codes, both[d], bool(d))
        return both

    def position_probabilities(self, codes: np.ndarray) -> np.ndarray:
        """(steps * windows, labels): a label for every position."""
        both = self.states(codes)
        logits = both[0].reshape(-1, HIDDEN) @ self.out[:HIDDEN]
        logits += both[1].reshape(-1, HIDDEN) @ self.out[HIDDEN:]
        logits += self.bias
        logits -= logits.max(1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(1, keepdims=True)
        return logits

    def predict(self, texts: list, undetermined: str) -> tuple[list[str], list[float]]:
        """Pooled label and probability of every text (None: undetermined).

        Windows of several texts share a pass; a long text goes through in
        several, and only sums are kept.
        """
        count, kinds = len(texts), len(self.labels)
        sums, letters = np.zeros((count, kinds)), np.zeros(count)
        held, owners, size = [], [], 0

        def flush():
            nonlocal held, owners, size
            if held:
                self._add(np.concatenate(held), np.concatenate(owners), sums, letters)
            held, owners, size = [], [], 0

        for i, text in enumerate(texts):
            if not text:
                continue
            raw = np.frombuffer(text.encode(), np.uint8)
            for at in range(0, len(raw), WINDOW * TOGETHER):
                part = raw[at:at + WINDOW * TOGETHER]
                windows = -(-len(part) // WINDOW)
                padded = np.zeros(windows * WINDOW, np.uint8)
                padded[:len(part)] = part
                held.append(padded.reshape(windows, WINDOW))
                owners.append(np.full(windows, i))
                size += windows
                if size >= TOGETHER:
                    flush()
        flush()
        names, scores = [], []
        means = sums / np.maximum(letters, 1)[:, None]
        best = means.argmax(1)
        for i in range(count):
            known = letters[i] > 0
            names.append(self.labels[best[i]] if known else undetermined)
            scores.append(float(min(1.0, means[i, best[i]])) if known else 0.0)
        return names, scores

    def _add(self, windows: np.ndarray, owners: np.ndarray, sums: np.ndarray, letters: np.ndarray) -> None:
        for at in range(0, len(windows), TOGETHER):
            part, own = windows[at:at + TOGETHER], owners[at:at + TOGETHER]
            codes = np.ascontiguousarray(part.T).astype(np.intp)
            weight = LETTER[codes]
            found = self.position_probabilities(codes).reshape(*codes.shape, -1)
            pooled = np.einsum("twk,tw->wk", found, weight.astype(np.float32))
            np.add.at(sums, own, pooled)
            np.add.at(letters, own, weight.sum(0))


def gradients(net: Network, codes: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Loss and gradients of all parameters by backpropagation through time."""
    steps, windows = codes.shape
    both = net.states(codes)
    weight = (LETTER[codes] / max(1, LETTER[codes].sum())).astype(np.float32).reshape(-1)
    flat = np.concatenate([both[0], both[1]], axis=2).reshape(-1, 2 * HIDDEN)
    logits = flat @ net.out + net.bias
    logits -= logits.max(1, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(1, keepdims=True)
    target = np.tile(labels, steps)
    loss = -float((np.log(p[np.arange(len(p)), target] + 1e-9) * weight).sum())
    p[np.arange(len(p)), target] -= 1
    p *= weight[:, None]
    d_out, d_bias = flat.T @ p, p.sum(0)
    d_states = (p @ net.out.T).reshape(steps, windows, 2, HIDDEN)
    d_inputs, d_recurrent = [], []
    for d in range(2):
        di, dr = np.zeros_like(net.inputs[d]), np.zeros_like(net.recurrent[d])
        dh = np.zeros((windows, HIDDEN), np.float32)
        order = range(steps) if d else range(steps - 1, -1, -1)  # against the direction of the run
        for t in order:
            earlier = t + 1 if d else t - 1
            h = both[d][earlier] if 0 <= earlier < steps else np.zeros((windows, HIDDEN), np.float32)
            v = np.tanh(net.inputs[d][codes[t]] + h @ net.recurrent[d])
            gate, fresh = 0.5 * v[:, :HIDDEN] + 0.5, v[:, HIDDEN:]
            dh = dh + d_states[t, :, d]
            d_pre = np.concatenate([dh * (fresh - h) * 0.5 * (1 - v[:, :HIDDEN] ** 2), dh * gate * (1 - fresh ** 2)], axis=1)
            np.add.at(di, codes[t], d_pre)
            dr += h.T @ d_pre
            dh = dh * (1 - gate) + d_pre @ net.recurrent[d].T
        d_inputs.append(di)
        d_recurrent.append(dr)
    return loss, [*d_inputs, *d_recurrent, d_out, d_bias]


def train(pairs: list[tuple[str, str]], steps: int = STEPS, seed: int = 7) -> Network:
    """Fit on (text, label) pairs with Adam; the order of pairs does not matter."""
    pairs = sorted((t, name) for t, name in pairs if t)
    labels = sorted({name for _, name in pairs})
    net, rng = Network(labels, seed), np.random.default_rng(seed)
    rows = np.zeros((len(pairs), WINDOW), np.intp)
    for i, (text, _) in enumerate(pairs):
        raw = text.encode()[:WINDOW]
        rows[i, :len(raw)] = np.frombuffer(raw, np.uint8)
    wanted = np.array([labels.index(name) for _, name in pairs])
    by_label = [np.flatnonzero(wanted == k) for k in range(len(labels))]
    first, second = [np.zeros_like(p) for p in net.parameters()], [np.zeros_like(p) for p in net.parameters()]
    for step in range(1, steps + 1):
        # as many rows of each label
        chosen = np.concatenate([rng.choice(own, max(1, BATCH // len(labels))) for own in by_label])
        _, grads = gradients(net, np.ascontiguousarray(rows[chosen].T), wanted[chosen])
        rate = RATE * (1 - 0.8 * step / steps)
        for p, g, m, v in zip(net.parameters(), grads, first, second, strict=True):
            g = np.clip(g, -1, 1)
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return net
