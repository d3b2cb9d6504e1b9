"""An adaptive context-mixing range coder for id sequences, in numpy.

Sequences are coded side by side, one lane each: a step codes the next id of all
lanes with array operations, and every lane has a model and a coder of its own
that start anew, so each sequence decodes without the others.

A lane numbers its different ids as they come; the ids themselves, in as many
bits as the largest has, precede the coder's words.  Per id, the contexts of one
and of two numbers before each predict a number (the last one that followed it,
with a confidence).  Whether the order-2 prediction, the order-1 prediction or
neither comes true has frequencies mixed from two adaptive statistics, by the
predictions' confidence and by what came true of late.  Neither: the number has
its adaptive order-0 frequency, how often the lane has come to it before; the
next new one has a frequency that grows with the number of different ids.  Both
make one interval, so an id takes one step of the coder.

The order-0 frequencies are places in the lane's past: its numbers so far, sorted
up to a step that follows closely, then as they came.  A number has the places
where the sorted part holds it, or the one where it came first.
"""

from __future__ import annotations

import numpy as np

from docweave.llm import common

U = np.uint64
#: The coder emits words of 32 bits and keeps its interval above that.
WORD, BOTTOM, LOW = U(32), U(1) << U(32), U((1 << 32) - 1)
#: Entries of the order-2 prediction table of a lane.
SLOT_BITS = 10
MOST_CONFIDENCE = 3
#: What an event adds to its frequency, and the sum at which frequencies are halved.
STEP, LIMIT = 32, 8000
#: Bits of the largest id, and ids in a sequence.
MOST_BITS, MOST_IDS = 30, 1 << 15


class Encoder:
    def __init__(self, lanes: int):
        self.low, self.range = np.zeros(lanes, U), np.full(lanes, ~U(0), U)
        self.sent = np.zeros(lanes, np.int64)
        self.at, self.words, self.carried = [], [], []

    def code(self, start, freq, part) -> None:
        """Narrow the intervals of the first lanes."""
        n = len(part)
        old = self.low[:n]
        low, size = old + start * part, part * freq
        over = np.flatnonzero(low < old)
        if len(over):
            self.carried.append((over, self.sent[over]))
        self.low[:n], self.range[:n] = low, size
        ready = np.flatnonzero(size < BOTTOM)
        if len(ready):
            self._put(ready, low[ready] >> WORD)
            self.low[ready] = low[ready] << WORD
            self.range[ready] = size[ready] << WORD

    def _put(self, at, words) -> None:
        self.at.append(at)
        self.words.append(words)
        self.sent[at] += 1

    def finish(self) -> list[bytes]:
        """The bytes of each lane."""
        # One more word says it where any word after it stays in the interval.
        wide = self.range >= BOTTOM << U(1)
        self._put(np.arange(len(wide)), (self.low >> WORD) + wide.astype(U))
        narrow = np.flatnonzero(~wide)
        self._put(narrow, self.low[narrow] & LOW)
        at, words = np.concatenate(self.at), np.concatenate(self.words)
        words = words[np.argsort(at, kind="stable")]
        ends = np.cumsum(self.sent)
        starts = ends - self.sent
        over = np.concatenate([np.zeros(0, np.int64)] + [starts[lanes] + sent - 1 for lanes, sent in self.carried])
        while len(over):
            np.add.at(words, over, U(1))
            full = np.unique(over[words[over] > LOW])
            words[full] &= LOW
            over = full - 1
        full = np.flatnonzero(words > LOW)
        while len(full):
            words[full] &= LOW
            words[full - 1] += U(1)
            full = full[words[full - 1] > LOW] - 1
        words = words.astype("<u4")
        return [words[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


class Decoder:
    def __init__(self, data: list[bytes]):
        sizes = np.array([len(d) // 4 for d in data], np.int64)
        self.words = np.frombuffer(b"".join(d[:len(d) // 4 * 4] for d in data) + b"\0" * 16, "<u4").astype(U)
        self.next = np.cumsum(sizes) - sizes
        self.value, self.range = np.zeros(len(data), U), np.full(len(data), ~U(0), U)
        for _ in range(2):
            self.value = (self.value << WORD) | self._pull(slice(None))

    def _pull(self, at) -> np.ndarray:
        # A damaged lane may run on; what it gets then does not matter.
        words = self.words.take(self.next[at], mode="clip")
        self.next[at] += 1
        return words

    def code(self, start, freq, part) -> None:
        n = len(part)
        value, size = self.value[:n] - start * part, part * freq
        ready = np.flatnonzero(size < BOTTOM)
        if len(ready):
            value[ready] = (value[ready] << WORD) | self._pull(ready)
            size[ready] <<= WORD
        self.value[:n], self.range[:n] = value, size


class _Outcomes:
    """Frequencies of the three outcomes and their sum, in 16 bits each from the
    lowest, for a number of contexts."""

    #: What each outcome adds.
    ADDS = np.array([STEP << 16 * k | STEP << 48 for k in range(3)], U)
    MOST = U(LIMIT << 48 | (1 << 48) - 1)

    def __init__(self, contexts: int):
        self.each = np.full(contexts, 1 | 1 << 16 | 1 << 32 | 3 << 48, U)

    def add(self, ctx, old, adds) -> None:
        new = old + adds
        big = np.flatnonzero(new > self.MOST)
        if len(big):
            parts = [((new[big] >> U(16 * k) & U(0xFFFF)) + U(1)) >> U(1) for k in range(3)]
            new[big] = parts[0] | parts[1] << U(16) | parts[2] << U(32) | sum(parts) << U(48)
        self.each[ctx] = new


class _Order0:
    """How often each lane has come to each of its numbers, and the places that
    stand for them."""

    def __init__(self, lanes: int, steps: int, kind, places: bool):
        self.steps = steps
        self.counts = np.zeros((lanes, steps), np.uint16)
        #: First place and how many, in 16 bits each.
        self.spans = np.zeros((lanes, steps), np.uint32)
        self.past = np.zeros((lanes, steps), kind) if places else None
        self.sorted, self.next = 0, 8

    def sort(self, step: int, n: int, since: np.ndarray, known: int) -> None:
        """Sort the first lanes' places up to a step; ``since`` has the numbers
        from the last sorting on, a row per step."""
        np.add.at(self.counts.reshape(-1), (since[:, :n] + np.arange(n) * self.steps).reshape(-1), np.uint16(1))
        counts = self.counts[:n, :known]
        ends = np.cumsum(counts, axis=1, dtype=np.uint32)
        self.spans[:n, :known] = (ends - counts) << np.uint32(16) | counts
        if self.past is not None:
            numbers = np.broadcast_to(np.arange(known, dtype=self.past.dtype), (n, known))
            self.past[:n, :step] = np.repeat(numbers.reshape(-1), counts.reshape(-1)).reshape(n, step)
        self.sorted, self.next = step, step + max(4, step >> 3)


#: The last three outcomes after one more.
_NEXT_RECENT = np.arange(81) % 27


def _run(coder, lengths: np.ndarray, numbers: np.ndarray | None) -> np.ndarray:
    """Code all steps of lanes whose lengths fall; the numbers, a row per step
    (None to decode)."""
    lanes, steps = len(lengths), int(lengths[0])
    kind = np.uint16 if steps <= 1 << 14 else np.uint32
    decode = numbers is None
    one_before, two_before = np.zeros(lanes * steps, kind), np.zeros(lanes << SLOT_BITS, kind)
    by_confidence, by_recent = _Outcomes(lanes * 32), _Outcomes(lanes * 27)
    order0 = _Order0(lanes, steps, kind, decode)
    spans = order0.spans.reshape(-1)
    past = order0.past.reshape(-1) if decode else None
    out = np.zeros((steps, lanes), kind) if decode else numbers
    p1, p2, recent, known = (np.zeros(lanes, np.int64) for _ in range(4))
    every = np.arange(lanes)
    row, row2, row32, row27 = every * steps, every << SLOT_BITS, every * 32, every * 27
    active = np.searchsorted(-lengths, -np.arange(steps), side="left")
    most = kind(MOST_CONFIDENCE)
    last = lanes
    for step in range(steps):
        n = int(active[step])
        if n < last:
            p1, p2, recent, known, row, row2, row32, row27 = (x[:n] for x in (p1, p2, recent, known, row, row2, row32, row27))
            last = n
        if step == order0.next:
            order0.sort(step, n, out[order0.sorted:step], int(known.max()))
        h1 = row + p1
        h2 = (p1 * 0x9E3779B1 + p2 * 0x27D4EB2F) >> 18 & ((1 << SLOT_BITS) - 1)
        h2 += row2
        e1, e2 = one_before.take(h1), two_before.take(h2)
        g1, g2, c1, c2 = e1 >> 2, e2 >> 2, e1 & 3, e2 & 3
        ctx = row32 + (c2 << 3 | c1 << 1 | (g1 == g2))
        ctx_recent = row27 + recent
        old, old_recent = by_confidence.each.take(ctx), by_recent.each.take(ctx_recent)
        mixed = old + old_recent
        f0 = mixed & U(0xFFFF)
        f01 = f0 + (mixed >> U(16) & U(0xFFFF))
        sums = mixed >> U(48)
        miss = sums - f01
        new_freq = np.maximum(known, 1).astype(U)
        events = new_freq + U(step)
        f0 *= events
        f01 *= events
        total = sums * events
        part = coder.range[:n] // total
        if decode:
            target = np.minimum(coder.value[:n] // part, total - U(1))
            missed = target >= f01
            second = target >= f0
            # Meant for the lanes that missed; the others' is cut to the range.
            place = np.minimum((target - f01) // miss, events - U(1))
            fresh = place < new_freq
            at = np.where(fresh, U(0), place - new_freq).astype(np.int64)
            number = np.where(fresh, known, past.take(row + at))
            now = np.where(missed, number, np.where(second, g1, g2))
            out[step, :n] = now
            past[row + step] = now
        else:
            now = number = numbers[step, :n].astype(np.int64)
            first = (now == g2) & (c2 > 0)
            second = ~first
            missed = second & ~((now == g1) & (c1 > 0))
            fresh = number == known
        span = spans.take(row + number)
        start = np.where(fresh, U(0), new_freq + (span >> np.uint32(16)))
        freq = np.where(fresh, new_freq, span & np.uint32(0xFFFF))
        start = np.where(missed, f01 + miss * start, np.where(second, f0, U(0)))
        freq = np.where(missed, miss * freq, np.where(second, f01 - f0, f0))
        coder.code(start, freq, part)
        fresh = np.flatnonzero(fresh & missed)
        spans[row[fresh] + known[fresh]] = step << 16 | 1
        known[fresh] += 1
        wanted = second.astype(np.int64) + missed
        adds = _Outcomes.ADDS.take(wanted)
        by_confidence.add(ctx, old, adds)
        by_recent.add(ctx_recent, old_recent, adds)
        entry = now.astype(kind)
        for slots, h, e, guess, c in ((one_before, h1, e1, g1, c1), (two_before, h2, e2, g2, c2)):
            # Right: surer, up to the most.  Wrong: less sure, and replaced at the least.
            right = (guess == entry) & (c > 0)
            slots[h] = np.where(right, e + (c < most), np.where(c > 1, e - kind(1), entry << 2 | kind(1)))
        p2, p1 = p1, now
        recent = _NEXT_RECENT.take(recent * 3 + wanted)
    return out


def _numbered(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ids of a block as they come, and the number of each id."""
    # Numpy sorts 16 bits by radix.
    keys = block.astype(np.uint16) if block.max() < 1 << 16 else block
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    firsts = order[starts]
    new = np.zeros(len(block), bool)
    new[firsts] = True
    number = np.empty(len(block), np.uint16)
    number[order] = np.repeat((np.cumsum(new) - 1)[firsts], np.diff(starts, append=len(block)))
    return block[new].astype(np.uint32), number


def _pack(ids: np.ndarray, bits: int) -> bytes:
    return np.packbits((ids[:, None] >> np.arange(bits, dtype=np.uint32)).astype(np.uint8) & 1).tobytes()


def _unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    each = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits).reshape(n, bits)
    return (each.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(1, dtype=np.uint32)


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """Each block of ids (below 2^30) coded: a u32 of the number of its different
    ids and, in the top five bits, the bits of the largest; these ids as they
    come; the coder's words."""
    lengths = np.array([len(b) for b in blocks], np.int64)
    order = np.argsort(-lengths, kind="stable")
    if not len(blocks) or not lengths.max():
        return [b""] * len(blocks)
    if lengths.max() > MOST_IDS:
        raise ValueError(f"a block has more than {MOST_IDS} ids")
    numbers, heads = np.zeros((len(blocks), int(lengths.max())), np.uint16), []
    for lane, i in enumerate(order):
        if not lengths[i]:
            break
        ids, numbers[lane, :lengths[i]] = _numbered(blocks[i])
        bits = int(ids.max()).bit_length()
        if bits > MOST_BITS:
            raise ValueError(f"an id has more than {MOST_BITS} bits")
        heads.append((bits << 27 | len(ids)).to_bytes(4, "little") + _pack(ids, bits))
    coder = Encoder(len(blocks))
    _run(coder, lengths[order], np.ascontiguousarray(numbers.T))
    out = [b""] * len(blocks)
    for i, head, words in zip(order, heads, coder.finish(), strict=False):
        out[i] = head + words
    return out


def decode(data: list[bytes], lengths: list[int]) -> list[np.ndarray]:
    """The blocks of the given lengths."""
    out = [np.zeros(0, np.uint32)] * len(data)
    lengths = np.asarray(lengths, np.int64)
    if not len(data) or not lengths.max():
        return out
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    ids, words = [], []
    for i in order:
        head = int.from_bytes(data[i][:4], "little")
        bits, known = head >> 27, head & (1 << 27) - 1
        end = 4 + (known * bits + 7) // 8
        if bits > MOST_BITS or not 0 < known <= lengths[i] <= MOST_IDS or end > len(data[i]):
            raise ValueError("a block is damaged")
        ids.append(_unpack(data[i][4:end], bits, known))
        words.append(data[i][end:])
    with np.errstate(divide="ignore"):
        numbers = np.ascontiguousarray(_run(Decoder(words), lengths[order], None).T)
    for lane, i in enumerate(order):
        # A damaged block may come to more numbers than it has ids.
        out[i] = ids[lane].take(numbers[lane, :lengths[i]], mode="clip")
    return out


common.by_value(__name__)
