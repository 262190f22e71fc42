"""airway.operators"""
