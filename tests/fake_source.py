"""Fetch function for the poll data source in tests: no network, deterministic points."""


def fetch(endpoint: str, tick: int) -> list[dict]:
    plant = endpoint.rsplit("/", 1)[-1]
    return [
        {"tag_name": f"\\\\{plant}\\PMP-{k}|Vibration", "asset_id": f"PMP-{k}",
         "timestamp": f"2026-08-10T06:{tick:02d}:00Z", "value": 2.0 + k + tick / 10.0,
         "quality": "Good", "uom": "mm/s", "source_system": "mock_pi", "plant_id": plant,
         "area_id": "AREA-COMPRESS"}
        for k in range(3)
    ]


def fail_after_one(endpoint: str, tick: int):
    """A poll that breaks off after its first point."""
    yield from fetch(endpoint, tick)[:1]
    raise ConnectionError(endpoint)
