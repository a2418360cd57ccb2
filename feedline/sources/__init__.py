"""Scans: landed payload pages, RSS items, source state, seen keys, manifests."""
