"""airway.functions"""
