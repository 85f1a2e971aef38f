"""Readers: landed JSON responses, warehouse tables, fixed dimensions."""
