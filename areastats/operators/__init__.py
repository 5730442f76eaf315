"""Cleaning, survey assembly, spatial joins and indicator families."""
