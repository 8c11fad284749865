"""Measures of sliding windows over per-frame tracks: frames are shuffled once, by panes, and windows are made of panes."""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import measured
from .windows import sliding_windows

#: Tracks in the torso frame, millimetres: left and right wrist, elbow and shoulder.
SIDES = {"wrist": ("lw", "rw"), "elbow": ("le", "re"), "shoulder": ("ls", "rs")}
POINTS = tuple(f"{p}_{a}" for pair in SIDES.values() for p in pair for a in "xyz")
#: Series of numbers and of flags that measures read beside the points.
NUMBERS = ("arm_speed", "arm_speed_2d", "hand_speed", "torso_speed", "kp_conf", "step_cosine", "step_cosine_right")
FLAGS = ("active", "speech", "smplh_valid", "box_valid", "hand_frozen")

# Parameters of the measures.
FAST_MM_S, TOGETHER_MM, RATIO_FLOOR = 4000.0, 180.0, 0.02
SEGMENT_S, OVERLAP_S, SAMPLE_S, BIN_S, MOST_LAG_S = 0.8, 0.2, 2.5, 0.5, 1.5
LEAST_COSINES, LEAST_BINS, LEAST_SAMPLES = 8, 8, 3
#: Windows of a block: what one task groups at a time.
WINDOWS_A_BLOCK = 32


def framed_windows(tracks: DataFrame, width: int, hop: int, columns: list[str], block: int = WINDOWS_A_BLOCK, late: Mapping[str, str] | None = None) -> DataFrame:
    """``file_id, window_index, f``: the frames of every window that fits its file, an array in order of frames.

    Frames go to blocks of windows (a frame near a border to two), once, and are gathered in panes as long as hop and width
    allow; windows are put together from the panes of their block. No frame is copied for each of its windows before the
    shuffle, and a block is all that a task holds of a file. Rows without file or with a negative frame are left out; one
    row a frame is expected. Windows without any frame don't occur. ``late`` gives columns as SQL over those of ``tracks``: they
    are computed after the shuffle, so that only what they are made of is moved.
    """
    late = {c: e for c, e in (late or {}).items() if c in columns}
    words = {w for e in late.values() for w in re.findall(r"\w+", e)}
    moved = [c for c in tracks.columns if c not in (*late, "file_id", "frame") and (c in columns or c in words)]
    pane = math.gcd(width, hop)
    o = F.col("frame").cast("bigint")
    rows = tracks.filter(F.col("file_id").isNotNull() & (o >= 0)).select("file_id", o.alias("frame"), *moved)
    first = F.greatest(F.lit(0).cast("bigint"), F.floor((o - width) / F.lit(hop)) + 1)
    blocks = F.sequence(F.floor(first / F.lit(block)), F.floor(F.floor(o / F.lit(hop)) / F.lit(block)))
    spread = rows.withColumn("b", F.explode(blocks)).withColumn("p", F.floor(o / F.lit(pane)))
    here = spread.repartition("file_id", "b").selectExpr("*", *[f"{e} AS {c}" for c, e in late.items()])
    here = here.withColumns({c: measured(c) for c in columns if c in (*POINTS, *NUMBERS)})
    panes = here.groupBy("file_id", "b", "p").agg(F.sort_array(F.collect_list(F.struct("frame", *columns))).alias("r"))
    whole = panes.groupBy("file_id", "b").agg(F.sort_array(F.collect_list(F.struct("p", "r"))).alias("panes"))
    lengths = rows.groupBy("file_id").agg((F.max("frame") + 1).alias("n"))
    k = F.col("window_index")
    fits = whole.join(lengths, "file_id").filter(F.col("n") - width >= F.col("b") * block * hop)
    last = F.least(F.floor((F.col("n") - width) / F.lit(hop)), F.col("b") * block + block - 1)
    each = fits.withColumn("window_index", F.explode(F.sequence(F.col("b") * block, last)))
    near = F.filter("panes", lambda x: (x["p"] >= k * (hop // pane)) & (x["p"] < k * (hop // pane) + width // pane))
    return each.select("file_id", "window_index", F.flatten(F.transform(near, lambda x: x["r"])).alias("f")).filter(F.size("f") > 0)


# ---- expressions over arrays of a window, as SQL text: hundreds of nested lambdas are parsed at once that way -----------
def let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, computed once also where a lambda reads it for each element."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def in_order(a: str) -> str:
    """The measured values of an array, sorted."""
    return f"sort_array(filter({a}, x -> x IS NOT NULL))"


def percentile_of(ordered: str, q: float) -> str:
    """Linear percentile of sorted values; NULL for none."""
    at = f"((size({ordered}) - 1) * {q!r}D)"
    low, high = f"get({ordered}, cast(floor({at}) AS int))", f"get({ordered}, cast(ceil({at}) AS int))"
    return f"({low} + ({at} - floor({at})) * ({high} - {low}))"


def share(a: str) -> str:
    """Share of TRUE among the entries of an array that aren't NULL; NULL for none."""
    return f"try_divide(size(filter({a}, x -> x)), size(filter({a}, x -> x IS NOT NULL)))"


def correlation(pairs: str, flat: float = 1e-12, least: int = 4) -> str:
    """Pearson's r of an array of (x, y), pairs with a NULL left out; NULL below ``least`` pairs or where either hardly varies.

    Means and sums of products are updated pair by pair, so large levels cost no digits.
    """
    known = f"filter({pairs}, p -> p.x IS NOT NULL AND p.y IS NOT NULL)"
    step = let(
        "named_struct('n', s.n + 1, 'dx', p.x - s.mx, 'dy', p.y - s.my)",
        "d",
        "named_struct('n', d.n, 'mx', s.mx + d.dx / d.n, 'my', s.my + d.dy / d.n, 'xx', s.xx + d.dx * (p.x - s.mx - d.dx / d.n), 'yy', s.yy + d.dy * (p.y - s.my - d.dy / d.n), 'xy', s.xy + d.dx * (p.y - s.my - d.dy / d.n))",
    )
    done = f"CASE WHEN s.n >= {least} AND sqrt(s.xx / s.n) > {flat!r}D AND sqrt(s.yy / s.n) > {flat!r}D THEN s.xy / sqrt(s.xx) / sqrt(s.yy) END"
    return f"CASE WHEN size({known}) >= {least} THEN aggregate({known}, named_struct('n', 0D, 'mx', 0D, 'my', 0D, 'xx', 0D, 'yy', 0D, 'xy', 0D), (s, p) -> {step}, s -> {done}) END"


def stretches(flags: str) -> str:
    """Half-open stretches (a, b) of positions in an array of flags where they hold, cut where a frame is missing."""
    held = "filter(sequence(0, size(z.a) - 1), i -> coalesce(get(z.a, i), false))"
    starts = f"filter({held}, i -> NOT coalesce(get(z.a, i - 1), false) OR coalesce(get(z.o, i) - get(z.o, i - 1) > 1, true))"
    ends = f"filter({held}, i -> NOT coalesce(get(z.a, i + 1), false) OR coalesce(get(z.o, i + 1) - get(z.o, i) > 1, true))"
    return let(f"struct({flags} AS a, f.frame AS o)", "z", f"zip_with({starts}, {ends}, (s, e) -> named_struct('a', s, 'b', e + 1))")


def with_enough(stretches: str, flags: str, least: int) -> str:
    """How many stretches hold ``least`` TRUE flags."""
    return let(f"struct({stretches} AS s, {flags} AS a)", "z", f"size(filter(z.s, x -> size(filter(slice(z.a, x.a + 1, x.b - x.a), y -> y)) >= {least}))")


def distance(x: str, y: str) -> str:
    """Distance of two points given as stems of column names: ``x_x, x_y, x_z``."""
    return "sqrt(" + " + ".join(f"({x}_{a} - {y}_{a}) * ({x}_{a} - {y}_{a})" for a in "xyz") + ")"


def _excursion(k: str) -> str:
    """How far the farther side of each frame is from its own median place in the window."""
    centre = ", ".join(f"{percentile_of(f'o_{p}_{a}', 0.5)} AS {p}_{a}" for p in SIDES[k] for a in "xyz")
    return let(f"struct({centre})", "m", "transform(f, x -> greatest(" + ", ".join(distance(f"x.{p}", f"m.{p}") for p in SIDES[k]) + "))")


def _extent(k: str) -> str:
    """Diagonal of the box that the farther side fills."""
    side = ("sqrt(" + " + ".join(f"pow(array_max(f.{p}_{a}) - array_min(f.{p}_{a}), 2)" for a in "xyz") + ")" for p in SIDES[k])
    return f"greatest({', '.join(side)})"


def _spread(p: str) -> str:
    """Mean distance between every two of a window's handful of samples."""
    each = f"transform(samples, (x, i) -> aggregate(slice(samples, i + 2, size(samples)), 0D, (s, y) -> s + {distance(f'x.{p}', f'y.{p}')}))"
    return f"(aggregate({each}, 0D, (s, x) -> s + x) / (size(samples) * (size(samples) - 1) / 2))"


def _abduction(elbow: str, shoulder: str) -> str:
    """Angle of an upper arm from straight down, in degrees."""
    return f"degrees(acos(greatest(-1D, least(1D, (x.{shoulder}_y - x.{elbow}_y) / ({distance(f'x.{elbow}', f'x.{shoulder}')} + 1e-9D)))))"


def _bins(width: int, hop: int, size: int) -> str:
    """Means of speed and speech in bins of ``size`` frames; frames of a bin are sought where lost frames can have moved them."""
    lost = f"({width} - size(f))"
    near = f"filter(slice(f, greatest(0, j * {size} - {lost}) + 1, {size} + {lost}), x -> (x.frame - window_index * {hop}) div {size} = j)"
    v = "filter(m.arm_speed, x -> x IS NOT NULL)"
    one = let(near, "m", f"named_struct('v', try_divide(aggregate({v}, 0D, (t, x) -> t + x), size({v})), 's', {share('m.speech')})")
    return f"transform(sequence(0, {width // size - 1}), j -> {one})"


def _varies(c: str, flat: float = 1e-9) -> str:
    """Do the bins' measured values differ, and are there enough of them?"""
    step = "named_struct('n', s.n + 1, 'm', s.m + (x - s.m) / (s.n + 1), 'v', s.v + (x - s.m) * (x - s.m) * s.n / (s.n + 1))"
    return f"aggregate(filter(bins.{c}, x -> x IS NOT NULL), named_struct('n', 0D, 'm', 0D, 'v', 0D), (s, x) -> {step}, s -> s.n >= {LEAST_BINS} AND sqrt(s.v / greatest(s.n, 1D)) > {flat!r}D)"


def _lagged(lag: int, bins: int) -> str:
    """Pairs of speed and the speech ``lag`` bins before it."""
    n = max(0, bins - abs(lag))
    return f"zip_with(slice(bins, {max(lag, 0) + 1}, {n}), slice(bins, {max(-lag, 0) + 1}, {n}), (a, b) -> named_struct('x', a.v, 'y', b.s))"


def window_measures(tracks: DataFrame, width: int, hop: int, fps: float = 30.0, block: int = WINDOWS_A_BLOCK, only: Sequence[str] | None = None, late: Mapping[str, str] | None = None) -> DataFrame:
    """All measures of every window of every file.

    ``tracks``: one row a frame with ``file_id, frame``, POINTS, NUMBERS and FLAGS; series are those of whole files, so values
    near a window's borders know their neighbours, while stretches are cut at the borders. NULL, NaN and infinite numbers are
    unmeasured and left out of percentiles, shares and correlations; a NULL flag doesn't hold, and isn't counted in shares.
    A measure that nothing was measured for is NULL. Where a window has no speech, posture is that of all its frames.
    Windows of less than two seconds have a status and no measure.

    Returns ``file_id, window_index, start_frame, end_frame, start_s, gesture_status`` and the measures, or those of ``only``;
    tracks that they don't need aren't moved, and needn't be there; those of ``late`` are SQL over others (``framed_windows``).
    """
    size, least, step = max(1, round(BIN_S * fps)), max(1, round(OVERLAP_S * fps)), max(1, round(SAMPLE_S * fps))
    lags, bins, arms = round(MOST_LAG_S / BIN_S), width // size, ("wrist", "elbow")
    status = "'ok'" if width >= round(2 * fps) else f"'window_too_short:{width}'"
    zeroth = {"fs": "filter(f, x -> x.speech)"}
    early = {"fp": "CASE WHEN size(fs) > 0 THEN fs ELSE f END"}
    first = {
        "o_speed": in_order("f.arm_speed"),
        "o_speech": in_order("fs.arm_speed"),
        "o_conf": in_order("f.kp_conf"),
        "o_cos": in_order("concat(f.step_cosine, f.step_cosine_right)"),
        "o_hand": in_order("f.hand_speed"),
        "o_torso": in_order("f.torso_speed"),
        "o_height": in_order("transform(fp, x -> greatest(x.lw_y, x.rw_y))"),
        "o_abd": in_order(f"transform(fp, x -> greatest({', '.join(_abduction(e, s) for e, s in zip(SIDES['elbow'], SIDES['shoulder'], strict=True))}))"),
        "samples": f"filter(fp, (x, i) -> i % {step} = 0)",
        "episodes": stretches("f.active"),
        "segments": stretches("f.speech"),
        "breaks": stretches("transform(f.smplh_valid, x -> NOT x)"),
        "bins": _bins(width, hop, size) if bins else "cast(array() AS array<struct<v: double, s: double>>)",
    } | {f"o_{p}_{a}": in_order(f"f.{p}_{a}") for k in arms for p in SIDES[k] for a in "xyz"}
    second = {
        "o_episode": "sort_array(transform(episodes, x -> cast(x.b - x.a AS double)))",
        "long": f"filter(segments, x -> x.b - x.a >= {round(SEGMENT_S * fps)})",
        "speech_rate": share("fs.active"),
        "silence_rate": share("filter(f, x -> NOT x.speech).active"),
        "corr": "array(" + ", ".join(f"named_struct('r', {correlation(_lagged(k, bins))}, 'lag', {k})" for k in range(-lags, lags + 1)) + ")",
        "even": f"coalesce({_varies('v')} AND {_varies('s')}, false)",
    } | {f"o_{k}": in_order(_excursion(k)) for k in arms}
    # of equal correlations the first lag
    third = {"best": "array_max(transform(filter(corr, c -> c.r IS NOT NULL), c -> named_struct('k', round(c.r, 12), 'l', -c.lag, 'r', c.r)))"}
    measures = {
        "window_frames": "size(f)",
        "window_seconds": f"{width / fps!r}D",
        "speech_seconds": f"size(fs) / {fps!r}D",
        "speech_frac": share("f.speech"),
        "smplh_valid_frac": share("f.smplh_valid"),
        "smplh_longest_invalid_s": f"coalesce(array_max(transform(breaks, x -> x.b - x.a)), 0) / {fps!r}D",
        "box_valid_frac": share("f.box_valid"),
        "hand_frozen_frac": share("f.hand_frozen"),
        "kp_conf_p10": percentile_of("o_conf", 0.1),
        "implausible_frac": share(f"transform(f.arm_speed, x -> x > {FAST_MM_S!r}D)"),
        "consistency_r": correlation("transform(f, x -> named_struct('x', x.arm_speed, 'y', x.arm_speed_2d))"),
        "step_cosine_p50": f"CASE WHEN size(o_cos) >= {LEAST_COSINES} THEN {percentile_of('o_cos', 0.5)} END",
        "step_cosine_n": "size(o_cos)",
        "wrist_excursion_p90_mm": percentile_of("o_wrist", 0.9),
        "wrist_range_mm": _extent("wrist"),
        "elbow_excursion_p90_mm": percentile_of("o_elbow", 0.9),
        "elbow_range_mm": _extent("elbow"),
        "hand_artic_p75_rad_s": percentile_of("o_hand", 0.75),
        "posture_spread_mm": f"CASE WHEN size(samples) >= {LEAST_SAMPLES} THEN greatest({', '.join(map(_spread, SIDES['wrist']))}) END",
        "wrist_height_p75_mm": percentile_of("o_height", 0.75),
        "hands_together_frac": share(f"transform(fp, x -> {distance('x.lw', 'x.rw')} < {TOGETHER_MM!r}D)"),
        "arm_abduction_p75_deg": percentile_of("o_abd", 0.75),
        "torso_travel_mm_s_p50": percentile_of("o_torso", 0.5),
        "arm_speed_p50_mm_s": percentile_of("o_speed", 0.5),
        "arm_speed_speech_p50_mm_s": percentile_of("o_speech", 0.5),
        "gesture_frac": share("f.active"),
        "gesture_frac_speech": "speech_rate",
        "gesture_frac_silence": "silence_rate",
        "gesture_speech_ratio": f"(speech_rate + {RATIO_FLOOR!r}D) / (silence_rate + {RATIO_FLOOR!r}D)",
        "episode_count": "size(episodes)",
        "episode_median_s": f"coalesce({percentile_of('o_episode', 0.5)} / {fps!r}D, 0D)",
        "episode_count_speech": with_enough("episodes", "f.speech", least),
        "gesture_seconds_speech": f"size(filter(fs.active, x -> x)) / {fps!r}D",
        "speech_segment_count": "size(long)",
        "speech_segments_covered": f"try_divide({with_enough('long', 'f.active', least)}, size(long))",
        "sync_r": "CASE WHEN even THEN best.r END",
        "sync_lag_s": f"CASE WHEN even THEN -best.l * {BIN_S!r}D END",
        "sync_r_zero": f"CASE WHEN even THEN get(corr, {lags}).r END",
    }
    if status != "'ok'":
        measures = {c: f"CASE WHEN false THEN {e} END" for c, e in measures.items()}
    if only is not None:
        measures = {c: measures[c] for c in only}
    stages, words = (zeroth, early, first, second, third), set(re.findall(r"\w+", " ".join(measures.values())))
    used: list[dict[str, str]] = []
    for made in reversed(stages):  # what the later stages and the measures read
        mine = {c: e for c, e in made.items() if c in words}
        words |= set(re.findall(r"\w+", " ".join(mine.values())))
        used.insert(0, mine)
    columns = [c for c in (*POINTS, *NUMBERS, *FLAGS) if c in words]
    w = framed_windows(tracks, width, hop, columns, block, late)
    for made in used:
        w = w.selectExpr("*", *[f"{e} AS {c}" for c, e in made.items()])
    place = {"start_frame": f"window_index * {hop}", "end_frame": f"window_index * {hop} + {width}", "start_s": f"window_index * {hop} / {fps!r}D", "gesture_status": status}
    return w.selectExpr("file_id", "window_index", *[f"{e} AS {c}" for c, e in (place | measures).items()])
