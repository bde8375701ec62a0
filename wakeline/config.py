"""Parameters of the analysis, all in one place."""

from __future__ import annotations

import math
from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    # Anchor, radii, thresholds and waypoints of the study.
    anchor: str = "KOSH"
    anchor_lat: float = 43.9844
    anchor_lon: float = -88.5570
    visit_radius_nm: float = 8.0
    visit_ceiling_ft: float = 3500.0
    box_lat: float = 0.16
    box_lon: float = 0.23
    gap_s: float = 900.0
    teleport_kt: float = 700.0
    teleport_nm: float = 5.0
    local_nm: float = 100.0
    min_leg_points: int = 15
    min_leg_s: float = 120.0
    same_instant_s: float = 0.5
    snap_nm: float = 3.0
    snap_agl_ft: float = 2000.0
    earth_nm: float = 3440.065
    ground_stop_s: float = 172_800.0
    near_nm: float = 20.0
    near_interval_s: float = 15.0
    far_interval_s: float = 60.0
    heading_deg: float = 12.0
    corridor: tuple[tuple[str, float, float], ...] = (
        ("ENDV", 43.7508, -89.4822),
        ("PPLK", 43.7403, -89.2247),
        ("GRN", 43.7689, -89.0472),
        ("RIPON", 43.8381, -88.8444),
        ("FISK", 43.9558, -88.6781),
    )
    corridor_min_gs: float = 40.0
    corridor_ceiling_ft: float = 4000.0
    corridor_buffer_nm: float = 5.0
    transit_span_nm: float = 15.0
    transit_points: int = 5
    low_ft: float = 1800.0
    high_ft: float = 2300.0
    tolerance_ft: float = 200.0
    zone: str = "America/Chicago"
    airport_types: tuple[str, ...] = ("small_airport", "medium_airport", "large_airport", "seaplane_base")

    @property
    def cos_anchor(self) -> float:
        return math.cos(math.radians(self.anchor_lat))

    @property
    def cos_corridor(self) -> float:
        return math.cos(math.radians(sum(w[1] for w in self.corridor) / len(self.corridor)))

    @property
    def legs_of_corridor(self) -> list[dict[str, float]]:
        """Start, vector, length and distance so far of each straight part, in local nautical miles."""
        xy = [(lon * 60 * self.cos_corridor, lat * 60) for _, lat, lon in self.corridor]
        out, so_far = [], 0.0
        for (ax, ay), (bx, by) in zip(xy, xy[1:]):
            length = math.sqrt((bx - ax) ** 2 + (by - ay) ** 2)
            out.append({"ax": ax, "ay": ay, "vx": bx - ax, "vy": by - ay, "len": length, "cum": so_far})
            so_far += length
        return out

    @property
    def waypoint_nm(self) -> dict[str, float]:
        parts = self.legs_of_corridor
        return dict(zip([w[0] for w in self.corridor], [*[p["cum"] for p in parts], parts[-1]["cum"] + parts[-1]["len"]]))


DEFAULT = Config()
