"""airway.streaming"""
