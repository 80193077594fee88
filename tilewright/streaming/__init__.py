"""Tiles that arrive while a run goes on."""
